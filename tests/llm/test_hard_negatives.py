"""Hard negatives against every pair of rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, ids string, team int"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    best = {}
    for i, label, vector, *_ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own = (label, [float(np.float32(x)) for x in vector])
        best[i] = min(best.get(i, own), own)
    known = {i: (label, [int(min(max(math.floor(256 * x), -(1 << 24)), 1 << 24)) for x in v]) for i, (label, v) in best.items()}
    score = lambda a, b: sum(x * y for x, y in zip(known[a][1], known[b][1]))
    out = []
    for a in (i for i in known if i % 10 == 0):
        near = sorted((-score(a, b), b) for b in known if b != a and known[b][0] == known[a][0])[:positives]
        for p, b in near:
            hard = sorted((-score(a, c), c) for c in known if known[c][0] != known[a][0] and low * -p <= 100 * score(a, c) <= high * -p)[:negatives]
            out += [(a, b, k, c, -p, -s) for k, (s, c) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives.mine(frame, F.expr("vec_id % 10 = 0")).collect()))


@pytest.mark.parametrize("kind", ["clusters", "copies", "norms"])
def test_every_pair(spark, monkeypatch, kind):
    """With small packs and shares, so that groups are split over many tasks."""
    for name, value in (("PACK", 16), ("SPLIT", 40), ("ANCHORS", 8), ("PILOT", 32), ("PIVOTS", 8), ("GROUPS", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(300):
        x = centres[i % 6] + 0.2 * rng.normal(size=12)
        if kind == "copies" and i % 3 == 0:
            x = centres[0]
        if kind == "norms":
            x = x * rng.choice([0.01, 1, 30])
        rows.append((i, int(rng.integers(0, 4)), [float(np.float32(v)) for v in x]))
    assert mined(spark, rows) == plain(rows)


def test_rows_far_away_are_not_sent(spark, monkeypatch):
    """Clusters far apart: a row serves few groups, not all."""
    monkeypatch.setattr(hard_negatives, "PACK", 64)
    rng = random.Random(2)
    rows = [(i, i % 2, [(100.0 if k == i % 4 else 0.0) + rng.random() for k in range(4)]) for i in range(400)]
    sent = []
    served = hard_negatives._served
    monkeypatch.setattr(hard_negatives, "_served", lambda *a: sent.append(served(*a)) or sent[-1])
    assert mined(spark, rows) == plain(rows)
    assert sent[0].agg(F.sum("n")).first()[0] < 2 * len(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, [1.0, 2.0]), (10, None, [1.0, 2.0]), (20, 1, None), (30, 1, [1.0, None]), (40, 1, [math.nan, 1.0]), (41, 1, [math.inf]),
        (50, 1, [1.0, 2.0, 0.5]), (51, 1, [1.0]), (52, 2, [0.5]), (53, 2, [0.5]), (54, 2, []), (55, 1, [1e30, 1.0]), (56, 3, [0.6, 1e30]),
        (60, 2, [1.0]), (60, 1, [2.0]), (60, 1, [2.0]), (-70, 3, [-1.0, -2.0]), (-71, 3, [-1.0]), (-72, 2, [-0.5]), (80, 9, [1.0]),
    ]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []
