"""Importance resampling towards a target text: hashed feature gains, and an exact draw by distributed radix selection."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, text_batches, words_of

#: Buckets of the features, the seed of the draw, its percentage, and the words a document needs.
BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 7, 25, 20
#: Bits of a key that one round of the selection looks at: 2 ** DIGIT counts reach the driver at most.
DIGIT = 12


def _lookup() -> np.ndarray:
    """What each byte becomes: A-Z lower case, other ASCII but letters and digits a blank."""
    out = np.arange(256, dtype=np.uint8)
    other = [b for b in range(128) if not chr(b).isalnum()]
    out[other] = 32
    out[65:91] += 32
    return out


_BYTES = _lookup()


def _plain(texts: pa.StringArray) -> pa.StringArray:
    """The texts with words separated by blanks alone."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    mapped = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(_BYTES[raw]))
    return mapped.cast(pa.string())


@functools.cache
def _appended() -> np.ndarray:
    """[n, k, b]: what byte k of a checksum, being b, turns into when n further bytes follow (all checksums are xors of these)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    now = np.array([np.arange(256, dtype=np.uint32) << (8 * k) for k in range(4)], dtype=np.uint32)
    out = [now]
    for _ in range(255):
        now = (now >> 8) ^ step[now & 255]
        out.append(now)
    return np.array(out)


def features(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of the texts' words and of their pairs of neighbours (text numbers beside them), and each text's word count.

    A pair's checksum comes from those of its words: that of the first with its
    blank is moved by the second's length, which is one table lookup a byte.
    """
    codes, counts, distinct = words_of(_plain(texts))
    raw = [w.encode() for w in distinct.to_pylist()]
    single = np.fromiter((zlib.crc32(w) for w in raw), np.uint32, len(raw))
    first = np.fromiter((zlib.crc32(b" ", c) for c in single.tolist()), np.uint32, len(raw))
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else np.zeros(0, np.intp)
    a, b = codes[at], codes[at + 1]
    table, moved = _appended(), single[b].copy()
    short = size[b] < len(table)
    left, n = first[a[short]], size[b[short]]
    moved[short] ^= table[n, 0, left & 255] ^ table[n, 1, (left >> 8) & 255] ^ table[n, 2, (left >> 16) & 255] ^ table[n, 3, left >> 24]
    for k in np.flatnonzero(~short).tolist():
        moved[k] = zlib.crc32(raw[b[k]], int(first[a[k]]))
    return np.concatenate([single[codes] % BUCKETS, moved % BUCKETS]).astype(np.intp), np.concatenate([owner, owner[at]]), counts


def _texts(table: DataFrame) -> DataFrame:
    return text_batches(table).select(F.col("text").cast("string").alias("text"))


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket's features occur in all texts; every task sends one count a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, part in slices(batches, "text"):
            total += np.bincount(features(part)[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in _texts(texts).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier each bucket is in the target, with one added to every count."""
    return np.floor(1000 * np.log((target + 1) * float(source.sum() + BUCKETS) / ((source + 1) * float(target.sum() + BUCKETS)))).astype(np.int64)


def weights(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row, in one pass without a shuffle."""
    schema = "doc_id long, n_words long, n_features long, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text"):
            bucket, owner, words = features(part)
            number = np.bincount(owner, minlength=len(part)).astype(np.int64)
            # sums of whole numbers below 2 ** 53 are exact in doubles
            total = np.bincount(owner, weights=gain[bucket], minlength=len(part)).astype(np.int64)
            weight = np.where(number > 0, total // np.maximum(number, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.astype(np.int64)) for c in (words, number, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    both = text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return both.mapInArrow(run, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """The draw's Gumbel noise in thousandths, from the first 8 hex digits of sha256(seed:doc_id)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def kth_key(rows: DataFrame, k: int) -> tuple[int, int]:
    """The k-th key (falling, id) in rising order, for k from 1 to the rows' number; both parts are long.

    Radix selection: each round counts one digit's values among the rows whose
    higher digits are known, and goes on in the value where the k-th lies. The
    rounds stay within the bits in which least and greatest key differ.
    """
    out: list[int] = []
    for part in ("falling", "id"):
        for name, value in zip(("falling", "id"), out, strict=False):
            rows = rows.where(F.col(name) == value)
        code = F.col(part).bitwiseXOR(F.lit(-(1 << 63)))  # rises as an unsigned number
        low, high = (x + (1 << 63) for x in rows.agg(F.min(part), F.max(part)).first())
        bits = (low ^ high).bit_length()
        value = high >> bits << bits
        while bits:
            step = min(DIGIT, bits)
            # 64 known bits less none: no digit is known yet
            same = F.shiftrightunsigned(code, bits) == value >> bits if bits < 64 else F.lit(True)
            bits -= step
            digit = F.shiftrightunsigned(code, bits).bitwiseAND(F.lit((1 << step) - 1))
            for d, n in sorted(map(tuple, rows.where(same).groupBy(digit.alias("digit")).count().collect())):
                if k <= n:
                    value |= d << bits
                    break
                k -= n
        out.append(value - (1 << 63))
    return out[0], out[1]


def ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with their rank from 1 in the order of the keys, which no two rows share: a range sort, and the parts' sizes summed up.

    One number a part reaches the driver, of which there are as many as
    shuffle partitions.
    """
    at = F.monotonically_increasing_id()
    # numbered in the sorting stage: part in the upper bits, place in the lower 33
    ordered = materialise(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", at))
    before, total = [], 0
    for part, n in sorted(map(tuple, ordered.groupBy(F.shiftright("at", 33).alias("part")).count().collect())):
        before.append((part, total))
        total += n
    parts = rows.sparkSession.createDataFrame(before, "part long, before long")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(parts), "part").withColumn("rank", F.col("before") + place + 1).drop("part", "before", "at")


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every document's (doc_id, n_features, weight, score, rank); rank counts the drawn ones from 1, others have null.

    Features are words and pairs of neighbours, hashed into buckets; a bucket's
    gain is how much likelier it is in the target's texts than in the
    documents', and a document weighs the floored mean of its gains. The score
    adds noise, so that the best percent of the documents with at least so many
    words are a draw by weight without replacement. The last key drawn is found
    by radix selection; only rows up to it are sorted, by range, and numbered.

    Null and empty texts have no features and weigh 0. Repeated rows are scored
    and drawn each for itself; rows with the same score and doc_id are told
    apart by their place in the table. A null doc_id counts as an empty one in
    the noise and comes last. An empty table gives no rows, an empty target
    gives gains by rarity alone; further columns are ignored.
    """
    gain = gains(bucket_counts(documents), bucket_counts(target))
    scored = weights(documents, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    id_ = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    rows = materialise(scored.select("doc_id", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("falling"), id_.alias("id"), F.monotonically_increasing_id().alias("row")))
    able = rows.where(F.col("n_words") >= least)
    drawn = percent * able.count() // 100
    columns = ("doc_id", "n_features", "weight", "score")
    if not drawn:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    falling, last = kth_key(able, drawn)
    up_to = (F.col("n_words") >= least) & ((F.col("falling") < falling) | (F.col("falling") == falling) & (F.col("id") <= last))
    best = ranked(rows.where(up_to), "falling", "id", "row").select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return best.unionByName(rows.where(~up_to).select(*columns, F.lit(None).cast("long").alias("rank")))
