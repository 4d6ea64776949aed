"""Near duplicates: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_ids, components, forget, materialise, mix, shingles, slices, text_batches, token_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at the least similarity shares a band with probability 1 - (1 - 0.8 ** 5) ** 10 = 0.98.
BANDS, ROWS = 10, 5
#: Shingles in a smaller share of the documents weigh as if they were in so many: the tasks get the others' counts, (shingles a document) / COMMON of them at most.
COMMON = 1 / 4000
#: Samples that estimate the similarity within buckets whose texts are not all linked; pairs this many standard deviations below the least similarity are not verified.
LONG, SLACK = 256, 3.0
#: Texts of such a bucket that are compared with each other at once.
BLOCK = 512
#: Shingles that one task counts.
COUNTED = 2_000_000
_SLICE = 3_000_000
_BLOCK = 16_384
_KEY = 5


def _grouped(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the keys, and in it where a new key and where a new pair of key and owner begins. Owners rise."""
    order = np.argsort(keys, kind="stable")
    s, o = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = s[1:] != s[:-1]
    pair = new.copy()
    pair[1:] |= o[1:] != o[:-1]
    return order, new, pair


def _places(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part that counts each key, and the key's 40 bits in it."""
    return ((keys >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24), keys & np.uint64((1 << 40) - 1)


class Frequencies:
    """The documents that have each common shingle; all others count as floor documents of total."""

    def __init__(self, part: np.ndarray, keys: np.ndarray, counts: np.ndarray, parts: int, floor: float, total: int):
        self.parts, self.total, self.floor = parts, max(1, total), max(1.0, floor)
        order = np.lexsort((keys, part))
        self.starts = np.searchsorted(part[order], np.arange(parts + 1))
        self.keys, self.counts = keys[order], np.maximum(counts[order], self.floor)

    def idf(self, keys: np.ndarray) -> np.ndarray:
        """1 + ln(total / documents): common shingles weigh less, but all weigh something."""
        out = np.full(len(keys), self.floor)
        if len(self.keys):
            part, low = _places(keys, self.parts)
            # one rising number for both, since parts are few and keys have 40 bits
            known = (np.repeat(np.arange(self.parts, dtype=np.uint64), np.diff(self.starts)) << np.uint64(40)) | self.keys
            wanted = (part << np.uint64(40)) | low
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            found = known[at] == wanted
            out[found] = self.counts[at[found]]
        return (1 + np.log(self.total / np.minimum(out, self.total))).astype(np.float32)


def frequencies(texts: DataFrame, common: float = COMMON) -> Frequencies:
    """Document frequencies of all shingles that at least a share of all documents has, counted over all documents.

    Each task counts the distinct shingles of its texts and deals them out by
    hash; other tasks add the counts up, COUNTED shingles each at most. So a
    shingle that all documents have costs one entry a slice of texts. Shingles
    are told apart by 40 bits within a part of the hashes.
    """
    total, chars = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    # a word has five characters at least with its blank, or there are fewer shingles still
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // (5 * COUNTED)))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in slices(batches, "text", _SLICE):
            keys, owner = shingles(*token_hashes(part), SHINGLE)
            if not len(keys):
                continue
            order, new, pair = _grouped(keys, owner)
            counts = np.add.reduceat(pair.astype(np.int32), np.flatnonzero(new)).astype(np.int32)
            place, low = _places(keys[order][new], parts)
            inner = np.lexsort((low, place))
            counts, raw = counts[inner], np.ascontiguousarray(low[inner].view(np.uint8).reshape(-1, 8)[:, :_KEY])
            ends = np.searchsorted(place[inner], np.arange(parts + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(ends))
            rows = [(int(p), raw[ends[p] : ends[p + 1]].tobytes(), counts[ends[p] : ends[p + 1]].tobytes()) for p in full]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "keys", "counts"])

    def added(group: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(group.column("keys").to_pylist()), np.uint8).reshape(-1, _KEY)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, :_KEY] = raw
        keys, counts = keys.view(np.uint64).ravel(), np.frombuffer(b"".join(group.column("counts").to_pylist()), np.int32)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.intp)
        sums = np.add.reduceat(counts[order].astype(np.int64), starts) if len(keys) else np.zeros(0, np.int64)
        often = sums >= max(2.0, common * total)
        found = keys[starts][often].astype(np.int64)
        return pa.table({"part": pa.array(np.full(len(found), group.column("part")[0].as_py()), pa.int32()), "key": found, "n": sums[often]})

    counted = texts.mapInArrow(local, "part int, keys binary, counts binary").groupBy("part").applyInArrow(added, "part int, key long, n long").toPandas()
    return Frequencies(counted["part"].to_numpy(np.uint64), counted["key"].to_numpy(np.int64).astype(np.uint64), counted["n"].to_numpy(np.float64), parts, common * total, total)


def weighted(part: pa.StringArray, of: Frequencies) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, token counts, and each text's distinct shingles with TF-IDF weights: keys, weights, owners."""
    tokens, counts = token_hashes(part)
    keys, owner = shingles(tokens, counts, SHINGLE)
    order, _, pair = _grouped(keys, owner)
    at = np.flatnonzero(pair)
    times = np.zeros(len(keys), np.int64)
    times[order[at]] = np.diff(np.append(at, len(keys)))
    keep = times > 0
    keys = keys[keep]
    return tokens, counts, keys, times[keep].astype(np.float32) * of.idf(keys), owner[keep]


class Sampler:
    """Improved consistent weighted sampling; a sample is told by the least value of ln a, which element and level determine.

    The Gamma(2, 1) and uniform variables of element and sample come from a
    64-bit mix of both: tables of quantiles stand for the Gamma variables.
    """

    def __init__(self, samples: int, family: int = 11):
        def gamma(n: int) -> np.ndarray:
            p, x = (np.arange(n) + 0.5) / n, np.full(n, 1.7)
            low, high = np.full(n, 1e-9), np.full(n, 60.0)
            for _ in range(80):  # bisection on the distribution function 1 - (1 + x) exp(-x)
                x = (low + high) / 2
                over = 1 - (1 + x) * np.exp(-x) > p
                low, high = np.where(over, low, x), np.where(over, x, high)
            return x

        r = gamma(1 << 12)
        self.r, self.inverse = r.astype(np.float32), (1 / r).astype(np.float32)
        self.log_c = np.log(gamma(1 << 16)).astype(np.float32)
        self.seeds = mix(np.arange(samples, dtype=np.uint64), family) | np.uint64(1)

    def samples(self, keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """texts x samples values; texts without elements have infinity."""
        out = np.full((texts, len(self.seeds)), np.inf, np.float32)
        log_w = np.log(weights)
        for low in range(0, len(keys), _BLOCK):
            key, lw, who = keys[low : low + _BLOCK], log_w[low : low + _BLOCK], owner[low : low + _BLOCK]
            starts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            own = who[starts]
            for k, seed in enumerate(self.seeds):
                x = key * seed
                x ^= x >> np.uint64(29)
                x *= np.uint64(0xA0761D6478BD642F)
                i = (x >> np.uint64(52)).astype(np.intp)
                r = self.r[i]
                beta = ((x >> np.uint64(32)) & np.uint64(0xFFFFF)).astype(np.float32) * np.float32(2**-20)
                t = np.floor(lw * self.inverse[i] + beta)
                value = self.log_c[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.intp)] - r * (t - beta + np.float32(1))
                out[own, k] = np.minimum(out[own, k], np.minimum.reduceat(value, starts))
        return out


def bands(samples: np.ndarray) -> np.ndarray:
    """texts x BANDS keys; a key belongs to one band only."""
    raw = samples.view(np.uint32).astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), raw.shape[:2])
    for k in range(ROWS):
        key = mix(key ^ raw[:, :, k], k + 1)
    return key


def signatures(texts: DataFrame, of: Frequencies) -> DataFrame:
    """(doc_id, copy, bands): copy is a 128-bit hash of the tokens, or of the raw text where there are none and no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        for batch, part in slices(batches, "text", _SLICE):
            tokens, counts, keys, weights, owner = weighted(part, of)
            table = bands(sampler.samples(keys, weights, owner, len(part))).view(np.int64)
            ends = np.cumsum(counts)
            copies = [xxhash.xxh3_128_digest(tokens[e - n : e].tobytes() if n else b"\0" + part[i].as_py().encode()) for i, (n, e) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True))]
            full = counts > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)), pa.array(table[full].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(copies, pa.binary()), lists], names=["doc_id", "copy", "bands"])

    return texts.mapInArrow(run, "doc_id long, copy binary, bands array<long>")


def vectors(texts: DataFrame, of: Frequencies) -> DataFrame:
    """(doc_id, keys, weights) of the texts' shingles; keys are the upper halves of the hashes and rise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text", _SLICE):
            _, _, keys, weights, owner = weighted(part, of)
            short = (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)
            order = np.lexsort((short, owner))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(short[order])), pa.ListArray.from_arrays(ends, pa.array(weights[order]))], names=["doc_id", "keys", "weights"])

    return texts.mapInArrow(run, "doc_id long, keys array<int>, weights array<float>")


def jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater weights; keys rise."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = b[at] == a if len(b) else np.zeros(len(a), bool)
    least = np.minimum(wa[both], wb[at[both]]).sum(dtype=np.float64)
    total = wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - least
    return float(least / total) if total else 0.0


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _verified(pairs: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) whose vectors are alike enough, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ka, va), (_, wa), (kb, vb), (_, wb) = (_flat(c) for c in batch.columns[2:])
            found = np.array([jaccard(va[ka[i] : ka[i + 1]], wa[ka[i] : ka[i + 1]], vb[kb[i] : kb[i + 1]], wb[kb[i] : kb[i + 1]]) for i in range(batch.num_rows)])
            keep = pa.array(found >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(found).filter(keep)], names=["a", "b", "similarity"])

    left = of.select(F.col("doc_id").alias("a"), F.col("keys").alias("ka"), F.col("weights").alias("wa"))
    right = of.select(F.col("doc_id").alias("b"), F.col("keys").alias("kb"), F.col("weights").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ka", "wa", "kb", "wb")
    return joined.mapInArrow(run, "a long, b long, similarity double")


def _long_signatures(known: DataFrame) -> DataFrame:
    """(node, signature) of LONG further samples, two bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(LONG, 12)
        for batch in batches:
            (ends, keys), (_, weights) = _flat(batch.column(1)), _flat(batch.column(2))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            table = sampler.samples(mix(keys[ends[0] : ends[-1]].view(np.uint32).astype(np.uint64)), weights[ends[0] : ends[-1]], owner, batch.num_rows)
            short = (mix(table.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in short], pa.binary())], names=["node", "signature"])

    return known.mapInArrow(run, "node long, signature binary")


def _likely(members: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of a bucket's members in different components that the signatures can't tell to be below least.

    members: (bucket, n, node, label, signature). A bucket is cut into blocks
    of about BLOCK members by hash, and each pair of blocks is compared in one
    task, so that no task holds a large bucket and only likely pairs are rows.
    """
    bar = LONG * (least - SLACK * math.sqrt(least * (1 - least) / LONG))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "label", "signature")

    def compared(group: pa.Table) -> pa.Table:
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        node, label, block = (group.column(c).to_numpy() for c in ("node", "label", "block"))
        table = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(len(node), LONG)
        columns = np.flatnonzero(block == y)
        a, b = [], []
        for i in np.flatnonzero(block == x).tolist():
            there = columns[(label[columns] != label[i]) & ((node[columns] > node[i]) | (x != y))]
            there = there[(table[there] == table[i]).sum(axis=1) >= bar]
            a.append(np.minimum(node[there], node[i]))
            b.append(np.maximum(node[there], node[i]))
        return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})

    return dealt.groupBy("bucket", "x", "y").applyInArrow(compared, "a long, b long").distinct()


def classes(documents: DataFrame, least: float = SIMILARITY, common: float = COMMON) -> DataFrame:
    """One row a document: class_id (the least doc_id of its class), kept (it is that one) and copy_of (the least doc_id with its very tokens).

    Classes are the connected components of all links of at least the given
    weighted Jaccard similarity between different texts that share a band.
    Copies are one node, so a group of them costs one row each. Of each band's
    bucket every member is first compared with the least one. Where members
    are still in different components, all pairs across these whose longer
    signatures make the similarity likely are verified too, block by block. So
    no link of a bucket is given up, and a group of near copies is not paired
    with itself.

    Texts without tokens are alike only if they are equal (null: empty). Rows
    that repeat a doc_id are one document, which any of their texts may link;
    rows without a doc_id are left out. An empty table gives no rows; further
    columns are ignored.
    """
    texts = text_batches(documents).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    of = frequencies(texts, common)
    signed = materialise(signatures(texts, of))
    firsts = materialise(signed.groupBy("copy").agg(F.min("doc_id").alias("node")))
    buckets = signed.join(firsts.select("copy", F.col("node").alias("doc_id")), ["copy", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    buckets = materialise(buckets)
    shared = materialise(buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1"))
    live = materialise(buckets.join(shared, "bucket"))
    forget(buckets, shared)
    ids = materialise(live.select(F.col("node").alias("doc_id")).distinct())
    known = materialise(vectors(texts.join(broadcast_ids(ids), "doc_id", "left_semi"), of))
    stars = materialise(live.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    links = materialise(_verified(stars, known, least).select("a", "b"))
    labels = components(links)
    placed = materialise(live.join(labels, "node", "left").select("bucket", "n", "node", F.coalesce("label", "node").alias("label")))
    mixed = materialise(placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket"))
    rest = materialise(placed.join(mixed, "bucket", "left_semi"))
    forget(live, ids, placed, mixed)
    if not rest.isEmpty():
        some = rest.select(F.col("node").alias("doc_id")).distinct()
        signs = materialise(_long_signatures(known.join(some, "doc_id", "left_semi")))
        likely = _likely(rest.join(signs, "node"), least).join(stars, ["a", "b"], "left_anti")
        links = links.union(materialise(_verified(materialise(likely), known, least).select("a", "b")))
        labels = components(links)
        forget(signs)
    forget(known, stars, rest)
    nodes = signed.select("doc_id", "copy").join(firsts, "copy").select("doc_id", "node")
    # a doc_id with several texts has several nodes: it joins them
    joined = nodes.groupBy("doc_id").agg(F.min("node").alias("copy_of"), F.max("node").alias("other"))
    joined = materialise(joined)
    if not (several := joined.where("copy_of < other")).isEmpty():
        own = nodes.join(several.select("doc_id", "copy_of"), "doc_id")
        labels = components(links.union(own.select("copy_of", "node")).union(own.select("copy_of", "doc_id")))
    return joined.join(labels, F.col("copy_of") == F.col("node"), "left").select("doc_id", F.coalesce("label", "copy_of").alias("class_id"), "copy_of").withColumn("kept", F.col("doc_id") == F.col("class_id"))


def deduplicate(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """documents with one row of each class: that of the least doc_id; rows without a doc_id stay. All columns stay.

    Of rows that share the kept doc_id the one with the least text stays.
    """
    gone = materialise(classes(documents, least).where("NOT kept").select("doc_id"))
    out = documents.join(broadcast_ids(gone), "doc_id", "left_anti").select(documents.columns)
    again = materialise(documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return out
    columns = [F.col(f"row.{c}").alias(c) for c in documents.columns]
    one = out.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*documents.columns), F.coalesce("text", F.lit(""))).alias("row")).select(columns)
    return out.join(again, "doc_id", "left_anti").unionByName(one)
