"""Helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Only in local mode (tests), where the session names none, a new folder of
    this machine takes its place; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='factloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """df written as Parquet below shared_dir() and read again, which cuts its lineage.

    A lost executor costs no recomputation of what came before. The table is
    removed by forget(), at the latest when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/factloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Removes tables that materialise() wrote and that no plan reads any more."""
    for table in tables:
        if path := getattr(table, "written_to", None):
            _remove(table.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session has ended before: nothing is left to do
        return


#: Ids that broadcast_ids() sends to the tasks at most: some 20 MB there.
BROADCAST_IDS = 1_000_000


def broadcast_ids(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast in joins if its counted size allows; else joins shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


#: Rows of an Arrow batch of texts; Spark's default of 10,000 would take several hundred MB of an executor for long ones.
BATCH_ROWS = 2_000


def text_batches(df: DataFrame) -> DataFrame:
    """df, whose session from now on sends BATCH_ROWS rows at a time to Python at most."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(df.sparkSession.conf.get(name))
    if rows <= 0 or rows > BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Parts of the batches with about limit bytes of text each, and their texts (null: empty).

    Every row is in exactly one part; a text that is longer than the limit is a part of its own.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(start, end - start), texts.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # the worker may live on for other work


def words_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """The texts' words (runs without ASCII white space) as numbers: codes, each text's word count, the distinct words.

    Splitting and numbering run in Arrow's compiled code, so that Python sees
    each distinct word of a part once and not each occurrence.
    """
    lists = pc.ascii_split_whitespace(texts)
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    codes, distinct, ends = flat.indices.to_numpy(), flat.dictionary, ends - ends[0]
    blank = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if blank >= 0:  # white space at a text's edge leaves empty words
        full = codes != blank
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        codes = codes[full]
    return codes, np.diff(ends), distinct


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over an array of uint64."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & MASK)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_TOKEN_BASE = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' tokens as 64-bit hashes, one text after the other, and each text's number of tokens.

    A token is a word in lower case without anything but letters, marks and
    digits; words without any are left out.
    """
    codes, counts, distinct = words_of(texts)
    plain = pc.utf8_lower(pc.replace_substring_regex(distinct, r"[^\p{L}\p{M}\p{N}]+", "")).to_pylist()
    full = np.fromiter(map(bool, plain), bool, len(plain))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, plain), np.uint64, len(plain))
    if not full.all():
        keep = full[codes]
        ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(counts)])]
        codes, counts = codes[keep], np.diff(ends)
    return hashes[codes], counts


def shingles(tokens: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of n tokens within a text, in order, and the number of each one's text.

    A text with fewer tokens, but some, has all of them as its only shingle.
    """
    size = len(tokens)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(size)
    first = np.zeros(size, bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    at = np.flatnonzero((left >= n) | first)
    key = tokens[at]
    for k in range(1, n):
        key = key * _TOKEN_BASE + np.where(left[at] > k, tokens[np.minimum(at + k, size - 1)], np.uint64(k))
    return mix(key), owner[at]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); label: the least node of its connected component.

    Contraction: in each round every node moves to the one of itself and its
    neighbours with the least hash, and edges between what moved together
    disappear. Hashes differ by round, so chains shrink by a constant share as
    well as stars do, and all rounds together are a small multiple of the first.
    Least neighbours are pre-aggregated; what they are joined with is a written
    table on both sides, so that Spark can split the edges of a hub. No edges
    give no rows; nulls are left out.
    """
    edges = materialise(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "near")
        order = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        moves.append(materialise(both.groupBy("node").agg(F.min(order("near")).alias("m")).select("node", F.least("m", order("node"))["to"].alias("to"))))
        x, y = moves[-1].toDF("a", "x"), moves[-1].toDF("b", "y")
        moved = edges.join(x, "a").join(y, "b").where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        last, edges = edges, materialise(moved)
        forget(last)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = moves[-1]
    for step in reversed(moves[:-1]):
        # what moved to a node without further edges has arrived
        after = roots.select(F.col("node").alias("to"), F.col("to").alias("root"))
        last, roots = roots, materialise(step.join(after, "to", "left").select("node", F.coalesce("root", "to").alias("to")))
        if last is not moves[-1]:
            forget(last)
    least = materialise(roots.groupBy("to").agg(F.min("node").alias("label")))
    labels = materialise(roots.join(least, "to").select("node", "label"))
    forget(edges, least, *moves, *([] if roots is moves[-1] else [roots]))
    return labels
