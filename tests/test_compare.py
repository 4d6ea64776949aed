"""Matching of facts against a plain reading of its rules."""

import random
import re

import pyarrow as pa
import pytest

from factloom import lexicons as lx
from factloom.functions.text import fold
from factloom.operators import compare
from factloom.operators import facts as read
from factloom.operators.gate import gate
from factloom.plans import facts as plans
from factloom.plans import votes as votes_plans


def share(x, y):
    return len(set(x) & set(y)) / min(len(set(x)), len(set(y))) if x and y else 0.0


def plain_numbers(a, b):
    taken, out = set(), []
    for i, x in enumerate(a):
        alone = sum(z["category"] == x["category"] for z in a) == 1 == sum(z["category"] == x["category"] for z in b)
        best = None
        for j, y in enumerate(b):
            if j in taken or x["category"] != y["category"]:
                continue
            if alone and (x["category"] != "age" or x["person"] and y["person"]):
                alike = 1.0
            elif x["label_key"] is not None and x["label_key"] == y["label_key"]:
                alike = share(x["words"], y["words"])
            else:
                continue
            if best is None or alike > best[1]:
                best = (j, alike)
        if best:
            taken.add(best[0])
            out.append({"i": i, "j": best[0], "similarity": best[1]})
    return out


def plain_units(a, b):
    out, told = [], set()
    for i, x in enumerate(a):
        for y in b:
            if x["category"] == y["category"] and abs(x["value"] - y["value"]) <= lx.TOLERANCE and x["unit"] != y["unit"] and (x["raw"], y["raw"]) not in told:
                told.add((x["raw"], y["raw"]))
                out.append({"raw_a": x["raw"], "raw_b": y["raw"], "i": i})
    return out


def facts(rng, n):
    out = []
    for _ in range(n):
        value, unit = rng.choice([1.0, 2.0, 2.0 + lx.TOLERANCE / 2]), rng.choice(["mg", "g"])
        category = rng.choice(["age", "dose", "dose", "lab"])
        out.append({"category": category, "label_key": rng.choice([None, "", "x", "y"]), "words": rng.sample("abcde", rng.randrange(4)), "person": rng.random() < 0.5, "value": value, "unit": unit, "raw": f"{value} {unit} {category}"})
    return out


@pytest.mark.parametrize("seed", range(3))
def test_plain_reading(seed):
    rng = random.Random(seed)
    sides = [([], []), (None, facts(rng, 2))] + [(facts(rng, rng.randrange(9)), facts(rng, rng.randrange(9))) for _ in range(200)]
    kind = pa.list_(pa.struct([("category", pa.string()), ("label_key", pa.string()), ("words", pa.list_(pa.string())), ("person", pa.bool_()), ("value", pa.float64()), ("unit", pa.string()), ("raw", pa.string())]))
    a, b = (pa.array([s[k] for s in sides], kind) for k in (0, 1))
    assert compare.numeric_pairs.func(a, b).to_pylist() == [plain_numbers(x or [], y or []) for x, y in sides]
    assert compare.unit_mismatches.func(a, b).to_pylist() == [plain_units(x or [], y or []) for x, y in sides]


def test_long_tables_stay_quick():
    """A thousand measures a side, all of one name or each of its own."""
    for name in (lambda k: "x", lambda k: f"n{k}"):
        own = [(name(k), frozenset((f"w{k % 50}", f"v{k % 7}"))) for k in range(1000)]
        assert len(compare.best_free(own, own[::-1])) == 1000


def test_folded_texts_match_as_without_case():
    """Every character against every letter of the patterns."""
    letters = sorted({c for p in (read._UNIT, read._PREDICATE, read._ANTONYM, read._CLAIM) for c in re.sub(r"\?P<\w+>|\\\w", "", p.pattern) if c.isalpha()})
    without_case = re.compile("[" + "".join(letters) + "]", re.IGNORECASE)
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x30000))):
        assert len(fold(c)[0]) == 1 and bool(without_case.match(c)) == (fold(c)[0] in letters), hex(ord(c))


@pytest.mark.parametrize("name", ["objective_findings", "detection_misses_topk", "detection_by_type", "gate_reasons", "interpretation_contradictions"])
def test_texts_are_read_once(spark, name):
    """Texts go to Python once, no facts with their surroundings come back, and a filter on findings does not repeat it."""
    plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "numeric_facts" not in plan and "polarity_facts" not in plan


WORDS = ["не", "нет", "без", "ни", "и", "боль", "купирован", "не купирована", "купирует", "спровоцирован", "выявлены", "отягощён", "подтверждён", "поступил", "выписан", "в норме", "норме", "изменений", "изменен не", "патологии", "без патологии", "исключён"]
WORDS += ["снижено", "повышено", "ниже нормы", "вследствие", "из-за", "изза", "по причине", "в  результате", "стала причиной", "привело к", "пациент", "гемоглобин", "АД", "Доза", "ᲀключён", "ᲂтягощён", "ᲀследствие", "КУПИРОВАН", "İ", "Σ"]
WORDS += [f"{n} {u}" for n in ("10", "10,5", "10.5", "120", "90/60", "2024", "١٢") for u in ("лет", "г", "г/л", "мг", "мм рт. ст.", "мм", "мкмоль/л", "минут", "%", "ед.", "ЧАСОВ")]


def texts(n, seed):
    """Source and summary with many words of the patterns, the second often the first with some words changed."""
    rng = random.Random(seed)

    def written(words):
        return "".join(w + rng.choice([" ", " ", " ", ", ", ". ", ".", ",", "\n", " (", ": ", " "]) for w in words)

    out = [(None, None), ("", None), (None, "10 мг"), ("", "")]
    for _ in range(n):
        own = rng.choices(WORDS, k=rng.randrange(14))
        other = [rng.choice(WORDS) if rng.random() < 0.2 else w for w in own] if rng.random() < 0.8 else rng.choices(WORDS, k=rng.randrange(14))
        out.append((written(own), written(other)))
    return out


def test_clauses_give_what_the_whole_text_gives():
    """Statements, claims and numbers of texts cut into clauses, against the patterns on the whole text."""
    for text in (t for pair in texts(3000, 1) for t in pair if t):
        folded = fold(text)[0]
        stated = [(m.start(), m.end(), text[m.start(m.lastindex or 0) : m.end()].lower()[:6], m.lastindex is None) for m in read._PREDICATE.finditer(folded)]
        stated += [(m.start(), m.end(), *read._ANTONYM_OF[m.lastindex - 1]) for m in read._ANTONYM.finditer(folded)]
        assert [(f.start, f.end, f.predicate, f.polarity) for f in read.statements(text)] == stated
        claims = [(k + start, k + end, name) for k, c in read.read(text).clauses for start, end, name in c.claims]
        assert claims == [(m.start(), m.end(), read._CLAIM_OF[m.lastindex - 1]) for m in read._CLAIM.finditer(folded)]
        assert [(f.start, f.end, f.unit_raw) for f in read.numbers(text)] == [(m.start(), m.end(), text[m.start("unit") : m.end()]) for m in read._UNIT.finditer(folded)]
    crossing = re.sub(r"\{\d,\d\}", "", "".join(p.pattern for p in (read._PREDICATE, read._ANTONYM, read._CLAIM)))
    assert not re.search(r"[.,]|\\[WDS]|\[\^", crossing), "a pattern may cross the end of a clause"


def test_long_clauses_are_not_kept():
    before = read._clause.cache_info().misses
    long = "боль не купирована " * 20
    assert len(read.statements(long)) == 40 and read._clause.cache_info().misses == before


def test_labels_end_at_the_last_boundary():
    for left in (t for pair in texts(300, 2) for t in pair if t):
        assert read.label(left) == " ".join(re.findall(lx.LABEL_WORD, re.split(r"[,;:.\n()]", left)[-1].lower())[-2:])


def test_counts_are_those_of_the_comparison(spark):
    """F2 F7: the counts alone, without phrases and contexts, and links looked for only where they may be."""
    rows = [(str(k), "m", a, b) for k, (a, b) in enumerate(texts(3000, 3))]
    pairs = spark.createDataFrame(rows, "emr_id string, model_id string, source_text string, summary_text string").repartition(4)
    known = compare.compare(pairs).selectExpr("emr_id", "objective.numeric.mismatch_count", "objective.numeric.unit_mismatch_count", "objective.polarity.flip_count", "objective.causality.introduced", "objective.interpretation.count").collect()
    found = compare.counted(pairs).select("emr_id", "counts.*").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, known)) and all(any(r[k] for r in known) for k in range(1, 6))
    of = "size(regexp_extract_all({}, '(?iU)(" + lx.CAUSAL.replace("\\", "\\\\") + ")'))"
    plain = pairs.selectExpr("emr_id", "greatest(" + of.format("coalesce(summary_text, '')") + " - " + of.format("coalesce(source_text, '')") + ", 0)").collect()
    assert sorted(map(tuple, plain)) == sorted((r[0], r[4]) for r in known)
    # F8: what the gate asks for comes with the counts
    gated = compare.counted(pairs, for_gate=True).selectExpr("emr_id", "counts.*", "kinds").drop("kinds").collect()
    assert sorted(map(tuple, gated)) == sorted(map(tuple, known))
    status = lambda rows: sorted((r.emr_id, str(r.gate)) for r in gate(rows).select("emr_id", "gate").collect())
    assert status(compare.counted(pairs, for_gate=True)) == status(compare.compare(pairs))


@pytest.mark.parametrize("name", ["candidate_ranking", "statistics_by_model"])
def test_counts_alone_come_back(spark, name):
    plan = votes_plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "tallied" in plan and "compared" not in plan
