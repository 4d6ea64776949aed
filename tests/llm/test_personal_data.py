"""Personal data against a plain reading of the patterns and of the measure."""

import hashlib
import math
import random
from collections import defaultdict

import regex

from factloom.llm import personal_data

EMAIL = regex.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = regex.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = regex.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = regex.compile(personal_data.TERM)


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    digits = lambda m: "".join(c for c in m[0] if c in "0123456789")
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def rendered(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in spans)


def value_of(kind, text):
    return (kind, "".join(c for c in text if c.isdigit()) if kind in (2, 3) else text.lower())


def revealing(texts):
    """{term: share of the information} by the definition, over different texts."""
    distinct, size = sorted(set(texts)), personal_data.CONTEXT
    patterns = (EMAIL, IP, CARD, PHONE)
    near, around, has, terms_in = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for t in distinct:
        for term in {m[0].lower() for m in TERM.finditer(t)}:
            terms_in[term].add(t)
        spans = base(t)
        for kind, s, e in spans:
            matches = [m.span() for m in patterns[kind].finditer(t)]
            before = max([b for _, b in matches if b <= s], default=0)
            after = min([a for a, _ in matches if a >= e], default=len(t))
            left, right = t[before:s], t[e:after]
            left = regex.sub(r"^\S+", "", left[-size:]) if len(left) > size else left
            right = regex.sub(r"\S+$", "", right[:size]) if len(right) > size else right
            value = value_of(kind, t[s:e])
            has[value].add(t)
            for term in {m[0].lower() for x in (left, right) for m in TERM.finditer(x)}:
                near[value, term].add(t)
                around[value, term].add((left, right))
    out = {}
    for (value, term), places in around.items():
        own = len(has[value]) / len(distinct)
        if len(places) >= personal_data.SUPPORT and own < 1:
            share = min(1.0, len(near[value, term]) / len(terms_in[term]))
            out[term] = max(out.get(term, 0), 1 - math.log(share) / math.log(own))
    return {t: r for t, r in out.items() if r >= personal_data.REVEAL}


def plain(docs):
    told = revealing([t or "" for _, t in docs])
    rows = []
    for i, text in docs:
        own = sorted(base(text or ""))
        more = sorted((4, *m.span()) for m in TERM.finditer(text or "") if m[0].lower() in told)
        rows.append((i, *(sum(k == n for k, _, _ in own) for n in range(4)), hashlib.sha256(rendered(own).encode()).hexdigest(), rendered(own + more), len(more)))
    return sorted(rows, key=str)


def corpus(seed):
    rng = random.Random(seed)
    plain_words = ["Zürich", "straße", "the", "house", "𝒜bc", "of", "river", "Ωmega", "x" * 40, "don't", "a.b", "end."]
    bits = ["a@b.cd", "x.y-z@mail.example.com.", "@", "a@b", "a@b.c@d.e", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0255.001.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "4" * 30, "+1 (415) 555-2671", "+12", "+49 30 1234567)", "++1 23 456 7890 ", "12", "a_b@c-d.e_f@g.hi", "0000000000000"]
    docs = [(k, " ".join(rng.choice(plain_words + (bits if rng.random() < 0.4 else [])) + rng.choice(["", "", "\n", ",", ""]) for _ in range(rng.randrange(0, 60)))) for k in range(120)]
    for k in range(8):  # the name stands by the number in several surroundings, and nearly nowhere else
        docs.append((500 + k, f"{rng.choice(plain_words)} {k} {rng.choice(plain_words)} Kowalska: +48 601 234 567 {rng.choice(plain_words)} number {k}"))
    docs += [(600, "kowalska alone"), (601, "Copied Brandt bob@copy.org"), (602, "Copied Brandt bob@copy.org"), (603, "Copied Brandt bob@copy.org"), (603, None), (None, ""), (7, "1" * 5000 + " " + "a" * 5000 + " " + "9 " * 3000)]
    return docs


def test_plain_reading(spark):
    docs = corpus(4)
    assert "kowalska" in revealing([t or "" for _, t in docs]) and "brandt" not in revealing([t or "" for _, t in docs])
    found = personal_data.scan(spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, key string, row int"))
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs)


def test_no_rows(spark):
    assert personal_data.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sanitise(spark):
    docs = corpus(5)
    told = revealing([t or "" for _, t in docs])
    frame = spark.createDataFrame([(i, t, len(t or ""), "k") for i, t in docs], "doc_id long, text string, n_chars long, key string")
    out = personal_data.sanitise(frame)
    assert out.columns == frame.columns and out.count() == len(docs)
    def cleaned(text):
        spans = [(s, -e, k) for k, s, e in base(text)] + [(m.start(), -m.end(), 4) for m in TERM.finditer(text) if m[0].lower() in told]
        done, last = "", 0
        for s, e, k in sorted(spans):
            if s >= last:
                general = "[NAME]" if text[s].isupper() else "[TERM]"
                mark = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")[k] if k < 4 else "" if told[text[s:-e].lower()] >= personal_data.REMOVE else general
                done += text[last:s] + mark
            last = max(last, -e)
        return done + text[last:]

    assert told and sorted(((r.doc_id, r.text, r.n_chars, r.key) for r in out.collect()), key=str) == sorted(((i, t and cleaned(t), len(cleaned(t or "")), "k") for i, t in docs), key=str)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[601] == "Copied Brandt [EMAIL]" and texts[603] in (None, "Copied Brandt [EMAIL]")
    assert "[NAME]" in texts[500] or "Kowalska" not in texts[500]


def test_no_python_workers(spark):
    plan = personal_data.scan(spark.createDataFrame(corpus(6)[:40], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
