"""Classes against brute-force weighted Jaccard over exact frequencies."""

import math
import random
from collections import Counter, defaultdict

import pytest

from factloom.llm import near_dedup


def shingle_counts(text):
    words = ["".join(c for c in w if c.isalnum()) for w in text.lower().split()]
    words = [w for w in words if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def links(rows, least=0.8):
    """Pairs of documents at the least similarity or more."""
    own = {d: shingle_counts(t or "") for d, t in rows}
    known = Counter(s for c in own.values() for s in c)
    weights = {d: {s: n * (1 + math.log(len(rows) / known[s])) for s, n in c.items()} for d, c in own.items()}
    at = defaultdict(list)
    for d, c in own.items():
        for s in c:
            at[s].append(d)
    pairs = {(a, b) for ds in at.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    out = set()
    for a, b in pairs:
        x, y = weights[a], weights[b]
        low = sum(min(w, y[s]) for s, w in x.items() if s in y)
        if low / (sum(x.values()) + sum(y.values()) - low) >= least:
            out.add((min(a, b), max(a, b)))
    return out


def components(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def corpus(seed, groups, copies, edits):
    """Texts of 120 words, and copies of each with some words changed, so that similarities lie around 0.8."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(120)]
        for k in range(copies):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(120)] = word()
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("groups, copies, edits", [(60, 5, 5), (2, 150, 5)])
def test_recall_and_precision_near_the_least_similarity(spark, groups, copies, edits):
    rows = corpus(7, groups, copies, edits)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    true = links(rows)
    together = sum(found[a] == found[b] for a, b in true)
    assert len(true) > 100 and together / len(true) >= 0.97
    of = components(true)
    assert all(of.get(d, d) == of.get(c, c) for d, c in found.items())


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = corpus(9, 1, 120, 6)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    true = links(rows)
    assert sum(found[a] == found[b] for a, b in true) / len(true) >= 0.97


def test_counts_are_exact(spark):
    rows = corpus(3, 20, 4, 4) + [(1000 + k, "the very same passage in many texts indeed") for k in range(50)]
    of = near_dedup.frequencies(spark.createDataFrame(rows, "doc_id long, text string"))
    known = Counter(s for _, t in rows for s in shingle_counts(t))
    assert of.total == len(rows) and sorted(of.counts.astype(int)) == sorted(n for n in known.values() if n >= 2)


def test_odd_rows(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text, 1), (2, text.upper() + " !!", 1), (3, None, 1), (4, "", 1), (5, "...", 1), (6, "...", 1), (None, text, 1), (7, "short one", 1), (7, text + " tail", 1), (8, "short one", 1), (8, "short one", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node long")
    got = {r.doc_id: (r.class_id, r.copy_of, r.kept) for r in near_dedup.classes(frame).collect()}
    assert {d: g[0] for d, g in got.items()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 5, 7: 1, 8: 1} and got[2] == (1, 1, False)
    kept = near_dedup.deduplicate(frame)
    assert kept.columns == frame.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 5]
    assert near_dedup.classes(frame.limit(0)).count() == near_dedup.deduplicate(frame.limit(0)).count() == 0
    again = spark.createDataFrame([(9, "b words", 1), (9, "a words", 2), (10, "others", 1)], "doc_id long, text string, h long")
    assert sorted((r.doc_id, r.text) for r in near_dedup.deduplicate(again).collect()) == [(9, "a words"), (10, "others")]
