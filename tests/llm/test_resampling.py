"""Resampling against a plain reading of the texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def feature_buckets(text):
    own = words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in own + [f"{a} {b}" for a, b in zip(own, own[1:])]]


def plain(docs, target, percent=25, least=20):
    source, aim = Counter(b for _, t in docs for b in feature_buckets(t)), Counter(b for t in target for b in feature_buckets(t))
    total, aimed = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (total + 10000) / ((source[b] + 1) * (aimed + 10000)))) for b in range(10000)]
    rows = []
    for k, (i, text) in enumerate(docs):
        found = feature_buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), k, len(words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[4]))
    rank = {r[4]: n for n, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(r[4])) for r in rows), key=str)


def made(seed, n):
    rng = random.Random(seed)
    vocabulary = ["Ünïcode", "naïve", "the", "The", "A1", "b_c", "日本語", "x" * 300, "straße", "end.", " gap", "-"] + [f"w{k}" for k in range(40)]
    return [(rng.choice([k, k, k - 1, None]), rng.choice([None, "", " ", " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 25, 60])))]) if rng.random() < 0.3 else " ".join(rng.choices(vocabulary, k=rng.randrange(15, 40)))) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_plain_reading(spark, seed):
    docs, target = made(seed, 400), [t for _, t in made(seed + 9, 20)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").coalesce(1)
    found = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, target)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(empty, empty).count() == 0
    some = spark.createDataFrame([(1, "word " * 30)] * 5, "doc_id long, text string")
    assert sorted(r.rank or 0 for r in resampling.resample(some, empty).collect()) == [0, 0, 0, 0, 1]


@pytest.mark.parametrize("spread", [0, 1, 1000, 1 << 62])
def test_every_kth_key(spark, spread):
    rng = random.Random(spread)
    keys = sorted((rng.randint(-spread, spread), rng.choice([5, -5, (1 << 63) - 1, -(1 << 63)]) if spread < 2 else rng.randint(-spread, spread)) for _ in range(60))
    frame = spark.createDataFrame(keys, "falling long, id long").cache()
    for k in (1, 2, 17, 59, 60):
        assert resampling.kth_key(frame, k) == keys[k - 1]


def test_ranks_over_many_parts(spark):
    frame = spark.range(0, 5000, 1, 7).select((F.col("id") % 3).alias("a"), F.col("id").alias("row"))
    found = {(r.a, r.row): r["rank"] for r in resampling.ranked(frame, "a", "row").collect()}
    assert found == {key: n for n, key in enumerate(sorted((k % 3, k) for k in range(5000)), 1)}


def test_checksums_of_pairs():
    """Words of every length, past the lookup table's end too."""
    text = " ".join("a" * n for n in range(1, 400))
    bucket, _, counts = resampling.features(pa.array([text, "", "B c"]))
    assert sorted(bucket.tolist()) == sorted(feature_buckets(text) + feature_buckets("B c"))
    assert counts.tolist() == [399, 0, 2]
