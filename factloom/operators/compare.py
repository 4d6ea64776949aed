"""Comparison of two texts' facts, row by row and without a shuffle: facts are found and matched by dictionaries in one pass over Arrow batches."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate
from math import floor
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from .. import lexicons as lx
from .facts import CLAIM_ARROW, CLAIMS, Found, Number, Read, Statement, array_of, causal_links, claimed, contradicted, contradictions, numbers, numeric_facts, polarity_facts, read, stated, statements
from .suspects import suspects


#: The categories of numbers and predicates of statements in both texts, all that the gate asks for.
KINDS = StructType([StructField(name, ArrayType(StringType())) for name in ("numbers_a", "numbers_b", "statements_a", "statements_b")])
_TEXTS, _PLACES = ArrayType(StringType()), ArrayType(IntegerType())
_NUMERIC = StructType([*(StructField(c, IntegerType()) for c in ("total_in_a", "matched", "mismatch_count", "unit_mismatch_count")), *(StructField(c, _TEXTS) for c in ("mismatches", "unit_mismatches")), StructField("covered", _PLACES), *(StructField(c, _TEXTS) for c in ("mismatch_contexts", "unit_mismatch_contexts"))])
_POLARITY = StructType([*(StructField(c, IntegerType()) for c in ("total_in_a", "matched", "flip_count")), *(StructField(c, _TEXTS) for c in ("flips", "flip_contexts"))])


def with_facts(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text") -> DataFrame:
    """pairs with numbers_a, numbers_b, statements_a, statements_b: the facts of both texts."""
    return pairs.withColumns({"numbers_a": numeric_facts(F.col(source)), "numbers_b": numeric_facts(F.col(summary)), "statements_a": polarity_facts(F.col(source)), "statements_b": polarity_facts(F.col(summary))})


_PAIRS = array_of(i=IntegerType(), j=IntegerType(), similarity=DoubleType())
_UNITS = array_of(raw_a=StringType(), raw_b=StringType(), i=IntegerType())
_ARROW_PAIR = [("i", pa.int32()), ("j", pa.int32()), ("similarity", pa.float64())]
_ARROW_UNIT = [("raw_a", pa.string()), ("raw_b", pa.string()), ("i", pa.int32())]


def _each(a: pa.Array, b: pa.Array, fields: Sequence[str]) -> Iterator[tuple[list, list]]:
    """Every row's facts of both sides as tuples of the fields."""

    def rows(column: pa.Array) -> Iterator[list]:
        flat = column.flatten()
        values = list(zip(*(flat.field(f).to_pylist() for f in fields), strict=True))
        at = 0
        for n in pc.fill_null(pc.list_value_length(column), 0).to_pylist():
            yield values[at : at + n]
            at += n

    yield from zip(rows(a), rows(b), strict=True)


def _structs(rows: list[list[tuple]], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    ends = [0, *accumulate(map(len, rows))]
    columns = [pa.array([x[k] for own in rows for x in own], kind) for k, (_, kind) in enumerate(fields)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, [name for name, _ in fields]))


def _share(x: frozenset, y: frozenset) -> float:
    """Words in common over the lesser number of words."""
    return len(x & y) / min(len(x), len(y)) if x and y else 0.0


def best_free(asked: list[tuple], offered: list[tuple], least: float = 0.0) -> list[tuple[int, int, float]]:
    """Greedy assignment in the order of asked: (i, j, similarity), each taking the free one of its key most alike, the first of equals.

    Both are (key, words) in text order; a null key has no partner. What is
    offered lies by key and by set of words, so that equal surroundings, which
    a long table of measures repeats, are compared once.
    """
    free: dict[str, dict[frozenset, list[int]]] = {}
    for j in range(len(offered) - 1, -1, -1):
        key, words = offered[j]
        if key is not None:
            free.setdefault(key, {}).setdefault(words, []).append(j)
    out = []
    for i, (key, words) in enumerate(asked):
        own = free.get(key)
        if not own:
            continue
        if len(own) == 1:  # nothing to choose from
            ((taken, js),) = own.items()
            share, j = _share(words, taken), -js[-1]
        else:
            share, j, taken = max(((_share(words, y), -js[-1], y) for y, js in own.items()), key=lambda c: c[:2])
        if share >= least:
            own[taken].pop()
            if not own[taken]:
                del own[taken]
            out.append((i, -j, share))
    return out


def _places(facts: Sequence) -> dict[str, list[int]]:
    """The places of facts by category."""
    out: dict[str, list[int]] = {}
    for k, f in enumerate(facts):
        if f.category in out:
            out[f.category].append(k)
        else:
            out[f.category] = [k]
    return out


def match_numbers(x: Sequence, y: Sequence, shares: bool = True) -> list[tuple[int, int, float]]:
    """Which numbers are the same measure: the only ones of their category (ages only of persons), else equal label sets, the context breaking ties. Without shares no similarity is told, and contexts are read only for ties."""
    first, second = _places(x), _places(y)
    sure = {}
    for category, own in first.items():
        others = second.get(category, ())
        if len(own) == 1 == len(others) and (category != "age" or x[own[0]].person and y[others[0]].person):
            sure[own[0]] = others[0]
    # a sure partner is the only one of its category, so it is in nobody's way; what the other side lacks has no partner
    taken = set(sure.values())
    rest = [i for i, f in enumerate(x) if i not in sure and f.category in second]
    free = [j for j, f in enumerate(y) if j not in taken and f.category in first]
    keys = lambda facts, places: [(facts[k].category, key) if (key := facts[k].label_key) is not None else None for k in places]
    asked, offered = keys(x, rest), keys(y, free)
    told = []
    if not shares and len(set(asked)) == len(asked) and len(set(offered)) == len(offered):
        by_key = dict(zip(offered, free, strict=True))
        told = [(i, by_key[key], 1.0) for i, key in zip(rest, asked, strict=True) if key is not None and key in by_key]
    elif rest and free:
        named = lambda facts, places, own: [(key, facts[k].word_set) for k, key in zip(places, own, strict=True)]
        told = [(rest[i], free[j], share) for i, j, share in best_free(named(x, rest, asked), named(y, free, offered))]
    return sorted([*told, *((i, j, 1.0) for i, j in sure.items())])


def match_statements(x: Sequence, y: Sequence) -> list[tuple[int, int, float]]:
    """Statements of the same predicate whose contexts share enough words."""
    keyed = lambda facts: [(f.predicate, f.word_set) for f in facts]
    return best_free(keyed(x), keyed(y), lx.CONTEXT_SHARE)


def _units_may_differ(x: Sequence, y: Sequence) -> bool:
    """False only where no value stands on both sides with other units: values within TOLERANCE share a whole part, taken on both edges."""
    seen: dict[str, str] = {}
    several = {f.category for f in (*x, *y) if seen.setdefault(f.category, f.unit) != f.unit}
    if not several:
        return False
    units: dict[tuple[str, int], set[str]] = {}
    for f in y:
        if f.category in several:
            for edge in {floor(f.value - lx.TOLERANCE), floor(f.value + lx.TOLERANCE)}:
                units.setdefault((f.category, edge), set()).add(f.unit)
    return any(own != {f.unit} for f in x if f.category in several and (own := units.get((f.category, floor(f.value)))))


def other_units(x: Sequence, y: Sequence) -> list[tuple[str, str, int]]:
    """Equal values of one category with other units, told once for each pair of phrases; the place is that of the first fact that says so."""
    if not _units_may_differ(x, y):
        return []

    def once(facts: Sequence) -> dict[str, tuple]:
        out: dict[str, tuple] = {}
        for k, f in enumerate(facts):
            if f.raw not in out:
                out[f.raw] = (k, f.category, f.value, f.unit, f.raw)
        return out

    by_value: dict[str, list[tuple]] = {}
    for j, category, value, unit, raw in once(y).values():
        by_value.setdefault(category, []).append((value, j, unit, raw))
    for facts in by_value.values():
        facts.sort()
    out = []
    for i, category, value, unit, raw in once(x).values():
        near = by_value.get(category, [])
        low, high = bisect_left(near, (value - lx.TOLERANCE,)), bisect_right(near, (value + lx.TOLERANCE, len(y)))
        out += [(raw, other, i) for _, other, theirs in sorted((j, r, u) for _, j, u, r in near[low:high]) if theirs != unit]
    return out


def _facts(fields: Sequence[str], rows: list[tuple]) -> list[SimpleNamespace]:
    return [SimpleNamespace(**dict(zip(fields, row, strict=True))) for row in rows]


@F.arrow_udf(_PAIRS)
def numeric_pairs(a: pa.Array, b: pa.Array) -> pa.Array:
    """match_numbers of facts as columns (see numeric_facts)."""
    fields = ("category", "label_key", "words", "person")

    def facts(rows: list[tuple]) -> list[SimpleNamespace]:
        return [SimpleNamespace(word_set=frozenset(f.words), **vars(f)) for f in _facts(fields, rows)]

    return _structs([match_numbers(facts(x), facts(y)) for x, y in _each(a, b, fields)], _ARROW_PAIR)


@F.arrow_udf(_UNITS)
def unit_mismatches(a: pa.Array, b: pa.Array) -> pa.Array:
    """other_units of facts as columns (see numeric_facts)."""
    fields = ("category", "value", "unit", "raw")
    return _structs([other_units(_facts(fields, x), _facts(fields, y)) for x, y in _each(a, b, fields)], _ARROW_UNIT)


def _column(rows: list[dict], kind: StructType) -> pa.Array:
    """Rows as an Arrow struct; the fields are integers and lists of one type."""
    arrow = {IntegerType: pa.int32(), StringType: pa.string()}
    of = lambda t: pa.list_(arrow[type(t.elementType)]) if isinstance(t, ArrayType) else arrow[type(t)]
    return pa.StructArray.from_arrays([pa.array([r[f.name] for r in rows], of(f.dataType)) for f in kind.fields], kind.names)


def _kinds(a: list[Number], b: list[Number], p: list[Statement], q: list[Statement]) -> dict:
    return {"numbers_a": [f.category for f in a], "numbers_b": [f.category for f in b], "statements_a": [f.predicate for f in p], "statements_b": [f.predicate for f in q]}


@F.arrow_udf(KINDS)
def kinds(source: pa.Array, summary: pa.Array) -> pa.Array:
    """The kinds of facts in both texts, without what surrounds them."""
    return _column([_kinds(numbers(a), numbers(b), statements(a), statements(b)) for a, b in zip(source.to_pylist(), summary.to_pylist(), strict=True)], KINDS)


def _numeric(a: list[Number], b: list[Number]) -> dict:
    same, units = match_numbers(a, b), other_units(a, b)
    wrong = [(a[i], b[j]) for i, j, _ in same if abs(a[i].value - b[j].value) > lx.TOLERANCE]
    near = lambda f: f.context[-lx.FINDING_WINDOW :]
    return {
        "total_in_a": len(a),
        "matched": len(same) - len(wrong),
        "mismatch_count": len(wrong),
        "unit_mismatch_count": len(units),
        "mismatches": [f"{x.raw} → {y.raw}" for x, y in wrong],
        "unit_mismatches": [f"{x} → {y}" for x, y, _ in units],
        "covered": list(dict.fromkeys([*(i for i, _, _ in same), *(i for _, _, i in units)])),
        "mismatch_contexts": [near(x) for x, _ in wrong],
        "unit_mismatch_contexts": [near(a[i]) for _, _, i in units],
    }


def _polarity(a: list[Statement], b: list[Statement]) -> dict:
    same = match_statements(a, b)
    flips = [(a[i], b[j]) for i, j, _ in same if a[i].polarity != b[j].polarity]
    return {"total_in_a": len(a), "matched": len(same) - len(flips), "flip_count": len(flips), "flips": [f"{x.raw} → {y.raw}" for x, y in flips], "flip_contexts": [x.context[-lx.FINDING_WINDOW :] for x, _ in flips]}


def _measures(a: Read, b: Read) -> set[tuple[str, float, str]]:
    """The categories, values and units of both texts."""
    out: set[tuple[str, float, str]] = set()
    for own in (a, b):
        for _, clause in own.clauses:
            out.update(clause.measures)
    return out


def _of(category: str, own: Read) -> list[tuple[int, Found]]:
    return [(at, f) for at, clause in own.clauses for f in clause.numbers if f.category == category]


def _same_measure(source: str, summary: str, x: list[tuple[int, Found]], y: list[tuple[int, Found]]) -> Iterator[tuple[tuple[int, Found], tuple[int, Found]]]:
    """match_numbers of one category; only ages and labels that repeat have to be read in their texts."""
    first, second = ({f.label_key: (at, f) for at, f in own} for own in (x, y))
    if len(x) == 1 == len(y) and x[0][1].category != "age":
        yield x[0], y[0]
    elif (len(x) > 1 or len(y) > 1) and len(first) == len(x) and len(second) == len(y):
        yield from ((p, second[key]) for key, p in first.items() if key is not None and key in second)
    else:
        a, b = ([Number(text, *f) for f in own] for text, own in ((source, x), (summary, y)))
        yield from ((x[i], y[j]) for i, j, _ in match_numbers(a, b, shares=False))


def wrong_numbers(source: str | None, summary: str | None, a: Read, b: Read, measures: set[tuple[str, float, str]]) -> list[tuple[Number, Number]]:
    """Numbers of the same measure that differ; only categories with more than one value need to be matched."""
    seen: dict[str, float] = {}
    moved = {category for category, value, _ in measures if seen.setdefault(category, value) != value}
    out = []
    for category in moved:
        x, y = _of(category, a), _of(category, b)
        if x and y:
            out += [(p, q) for p, q in _same_measure(source, summary, x, y) if abs(p[1].value - q[1].value) > lx.TOLERANCE]
    return sorted(((Number(source, *p), Number(summary, *q)) for p, q in out), key=lambda pair: pair[0].start)


def wrong_units(source: str | None, summary: str | None, a: Read, b: Read, measures: set[tuple[str, float, str]]) -> tuple[list[Number], list[tuple[str, str, int]]]:
    """The source's numbers, and other_units of both texts; nothing where no value stands with two units (values as they are read are equal or far apart)."""
    seen: dict[tuple[str, float], str] = {}
    if all(seen.setdefault((category, value), unit) == unit for category, value, unit in measures):
        return [], []
    own = numbers(source, a)
    return own, other_units(own, numbers(summary, b))


def flipped(source: str | None, summary: str | None, a: Read, b: Read) -> list[tuple[Statement, Statement]]:
    """Statements that change their polarity; only predicates that occur with both need to be matched."""
    told: set[tuple[str, bool]] = set()
    for own in (a, b):
        for _, clause in own.clauses:
            told.update(clause.polarities)
    moved = {name for name, polarity in told if not polarity and (name, True) in told}
    if not moved:
        return []
    x, y = statements(source, a, moved), statements(summary, b, moved)
    return [(x[i], y[j]) for i, j, _ in match_statements(x, y) if x[i].polarity != y[j].polarity]


_COMPARED = StructType([StructField("kinds", KINDS), StructField("numeric", _NUMERIC), StructField("polarity", _POLARITY), StructField("links_a", BooleanType()), StructField("links_b", BooleanType())])
_COUNTED = StructType([*(StructField(c, IntegerType()) for c in ("numeric_mismatches", "unit_mismatches", "flips")), StructField("links_a", BooleanType()), StructField("links_b", BooleanType())])


@F.arrow_udf(_COMPARED)
def compared(source: pa.Array, summary: pa.Array) -> pa.Array:
    """What the facts of two texts say, found and matched in one pass, so that the facts themselves stay here; and whether the texts may have causal links."""
    of_kinds, numeric, polarity, links = [], [], [], []
    for a, b in zip(source.to_pylist(), summary.to_pylist(), strict=True):
        x, y = read(a), read(b)
        own = numbers(a, x), numbers(b, y), statements(a, x), statements(b, y)
        of_kinds.append(_kinds(*own))
        numeric.append(_numeric(*own[:2]))
        polarity.append(_polarity(*own[2:]))
        links.append((x.links, y.links))
    told = [_column(of_kinds, KINDS), _column(numeric, _NUMERIC), _column(polarity, _POLARITY)]
    return pa.StructArray.from_arrays([*told, *(pa.array([own[k] for own in links], pa.bool_()) for k in (0, 1))], _COMPARED.names)


_GATED = StructType([*_COUNTED.fields, StructField("kinds", KINDS)])


def _tally(source: pa.Array, summary: pa.Array, of_kinds: list[dict] | None = None) -> list[pa.Array]:
    rows = []
    for a, b in zip(source.to_pylist(), summary.to_pylist(), strict=True):
        x, y = read(a), read(b)
        measures = _measures(x, y)
        rows.append((len(wrong_numbers(a, b, x, y, measures)), len(wrong_units(a, b, x, y, measures)[1]), len(flipped(a, b, x, y)), x.links, y.links))
        if of_kinds is not None:
            of_kinds.append({"numbers_a": _measured(x), "numbers_b": _measured(y), "statements_a": stated(x), "statements_b": stated(y)})
    return [pa.array([r[k] for r in rows], pa.int32() if k < 3 else pa.bool_()) for k in range(5)]


def _measured(own: Read) -> list[str]:
    """The categories of numbers, each once."""
    return list(dict.fromkeys(category for _, clause in own.clauses for category, _, _ in clause.measures))


@F.arrow_udf(_COUNTED)
def tallied(source: pa.Array, summary: pa.Array) -> pa.Array:
    """The counts of compared alone: no phrase or context is cut out, and only what can differ is matched."""
    return pa.StructArray.from_arrays(_tally(source, summary), _COUNTED.names)


@F.arrow_udf(_GATED)
def tallied_for_gate(source: pa.Array, summary: pa.Array) -> pa.Array:
    """tallied, with the kinds of facts in both texts, each once."""
    of_kinds: list[dict] = []
    return pa.StructArray.from_arrays([*_tally(source, summary, of_kinds), _column(of_kinds, KINDS)], _GATED.names)


_PHRASES = ("mismatches", "mismatch_contexts", "unit_mismatches", "unit_mismatch_contexts", "flips", "flip_contexts")
_WRONG = StructType([*(StructField(c, _TEXTS) for c in _PHRASES), StructField("claims", CLAIMS), StructField("links_a", BooleanType()), StructField("links_b", BooleanType())])


@F.arrow_udf(_WRONG)
def wrong(source: pa.Array, summary: pa.Array) -> pa.Array:
    """What of compared says that something is wrong: only what can differ is matched, and only what differs is cut out."""
    near = lambda f: f.context[-lx.FINDING_WINDOW :]
    phrase = lambda a, b: f"{a.raw} → {b.raw}"
    may = suspects(source, summary)
    of = list(zip(may.numbers.tolist(), may.units.tolist(), may.polarities.tolist(), strict=True))
    found: list[list] = [[] for _ in range(7)]
    counts = np.zeros((7, len(source)), np.int32)
    for k in may.places():
        by_number, by_unit, by_polarity = of[k]
        a, x = may.texts.read(k) if by_number or by_unit or by_polarity else (None, Read([]))
        b, y = may.texts.read(len(source) + k)
        measures = _measures(x, y) if by_number or by_unit else set()
        moved = wrong_numbers(a, b, x, y, measures) if by_number else []
        own, units = wrong_units(a, b, x, y, measures) if by_unit else ([], [])
        turned = flipped(a, b, x, y) if by_polarity else []
        told = [[phrase(*p) for p in moved], [near(f) for f, _ in moved], [f"{p} → {q}" for p, q, _ in units], [near(own[i]) for _, _, i in units], [phrase(*p) for p in turned], [near(f) for f, _ in turned], claimed(b, y)]
        for own_column, rows in zip(found, told, strict=True):
            own_column += rows
        counts[:, k] = [len(rows) for rows in told]
    kinds = [*[pa.string()] * 6, CLAIM_ARROW.value_type]
    ends = np.concatenate([np.zeros((7, 1), np.int32), np.cumsum(counts, axis=1, dtype=np.int32)], axis=1)
    columns = [pa.ListArray.from_arrays(pa.array(end), pa.array(rows, kind)) for end, rows, kind in zip(ends, found, kinds, strict=True)]
    return pa.StructArray.from_arrays([*columns, pa.array(may.links_a), pa.array(may.links_b)], _WRONG.names)


def _links(may: str, text: str) -> Column:
    """The causal links of texts that may have some."""
    return F.when(F.col(may), causal_links(F.col(text))).otherwise(F.array().cast("array<string>"))


def counted(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text", for_gate: bool = False) -> DataFrame:
    """pairs with counts: struct<numeric_mismatches, unit_mismatches, flips, causal, claims>, the counts of what compare tells; for the gate with kinds too, each kind once."""
    told = tallied_for_gate if for_gate else tallied
    done = pairs.withColumns({"_claims": F.size(contradictions(F.col(summary))), "_done": told.asNondeterministic()(F.col(source), F.col(summary))})
    introduced = F.when(F.col("_done.links_b"), F.greatest(F.size(causal_links(F.col(summary))) - F.size(_links("_done.links_a", source)), F.lit(0))).otherwise(0)
    counts = F.struct(*(F.col(f"_done.{c}").alias(c) for c in ("numeric_mismatches", "unit_mismatches", "flips")), introduced.alias("causal"), F.col("_claims").alias("claims"))
    return done.withColumns({"counts": counts} | ({"kinds": F.col("_done.kinds")} if for_gate else {})).drop("_done", "_claims")


def with_kinds(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text") -> DataFrame:
    """pairs with kinds (see KINDS), for the gate alone."""
    return pairs.withColumn("kinds", kinds.asNondeterministic()(F.col(source), F.col(summary)))


def compare(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text") -> DataFrame:
    """pairs with the columns of with_facts, kinds and a struct objective: numeric, polarity, causality, interpretation.

    Null and empty texts have no facts, so all their counts are 0. Repeated
    rows are compared each for itself. The columns of with_facts are read from
    the texts once more, where they are asked for. The comparison counts as
    nondeterministic, so that a filter on it does not have it done twice.
    """
    done = with_facts(pairs, source, summary).withColumns({"_claims": contradictions(F.col(summary)), "_done": compared.asNondeterministic()(F.col(source), F.col(summary))}).withColumns({"_links_a": _links("_done.links_a", source), "_links_b": _links("_done.links_b", summary)})
    introduced = F.greatest(F.size("_links_b") - F.size("_links_a"), F.lit(0))
    causality = F.struct(F.size("_links_a").alias("in_a"), F.size("_links_b").alias("in_b"), introduced.alias("introduced"), F.slice("_links_b", F.lit(1), introduced).alias("introduced_markers"))
    interpretation = F.struct(F.col("_claims").alias("contradictions"), F.size("_claims").alias("count"))
    objective = F.struct(F.col("_done.numeric").alias("numeric"), F.col("_done.polarity").alias("polarity"), causality.alias("causality"), interpretation.alias("interpretation"))
    return done.withColumns({"objective": objective, "kinds": F.col("_done.kinds")}).drop("_done", "_links_a", "_links_b", "_claims")


def wrongs(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text", **more: Column) -> DataFrame:
    """pairs with objective: the fields of compare's that tell what is wrong (mismatches, flips, introduced links, contradictions, with counts and contexts), without what is right.

    more: further columns to find in the same pass over the texts.
    """
    done = pairs.withColumns({"_wrong": wrong.asNondeterministic()(F.col(source), F.col(summary)), **more})
    # links of the source count only where the summary has some
    linked = done.withColumns({"_links_b": _links("_wrong.links_b", summary), "_links_a": F.when(F.col("_wrong.links_b"), _links("_wrong.links_a", source)).otherwise(F.array().cast("array<string>")), "_claims": contradicted(F.col("_wrong.claims"))})
    introduced = F.greatest(F.size("_links_b") - F.size("_links_a"), F.lit(0))
    told = lambda *names: [F.col(f"_wrong.{name}").alias(name) for name in names]
    number = F.struct(F.size("_wrong.mismatches").alias("mismatch_count"), F.size("_wrong.unit_mismatches").alias("unit_mismatch_count"), *told(*_PHRASES[:4]))
    polarity = F.struct(F.size("_wrong.flips").alias("flip_count"), *told(*_PHRASES[4:]))
    causality = F.struct(introduced.alias("introduced"), F.slice("_links_b", F.lit(1), introduced).alias("introduced_markers"))
    interpretation = F.struct(F.col("_claims").alias("contradictions"), F.size("_claims").alias("count"))
    return linked.withColumn("objective", F.struct(number.alias("numeric"), polarity.alias("polarity"), causality.alias("causality"), interpretation.alias("interpretation"))).drop("_wrong", "_links_a", "_links_b", "_claims")


def flags(objective: Column) -> dict[str, Column]:
    """What a rule caught, by kind of finding."""
    return {
        "caught_numeric": objective["numeric"]["mismatch_count"] > 0,
        "caught_unit": objective["numeric"]["unit_mismatch_count"] > 0,
        "caught_polarity": objective["polarity"]["flip_count"] > 0,
        "caught_causality": objective["causality"]["introduced"] > 0,
        "caught_interpretation": objective["interpretation"]["count"] > 0,
    }
