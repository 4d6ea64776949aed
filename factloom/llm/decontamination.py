"""Benchmark decontamination by spaced seeds: masked token hashes of both sides are joined, hits verified by a tolerant alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, materialise, mix, slices, text_batches, token_hashes

#: Token positions that count (1) or are ignored (0). Five or more ones each, of different shapes.
MASKS = ("111111", "1111011", "11011011", "1110010111", "111101111", "1011101101")
#: An overlap counts from this many tokens on, or from the whole item if that is shorter.
MIN_TOKENS = 13
#: Items of fewer tokens are found only where they are a whole document.
MIN_ITEM_TOKENS = 5
#: An overlap has this many equal tokens a substitution at least: it is 0.8 alike.
MISMATCH_COST = 4
#: The filter of seed hashes that goes to the tasks has at most so many bits, whatever the benchmark's size; a fuller one lets more documents through to the join.
FILTER_BITS = 1 << 27
#: Items that are compared with a document at once.
ITEMS_AT_ONCE = 1_000

FOUND = "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_equal long, item_tokens long"
_SLICE = 3_000_000
_SPAN = max(map(len, MASKS))
_CHUNK = 1 << 16
_PAIRS = 4_000_000

Mask = tuple[int, ...]


def best_overlap(equal: np.ndarray) -> tuple[int, int]:
    """(start, end) of the longest run with at least MISMATCH_COST equal tokens a substitution, at its edges too; the first such run."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH_COST))])
    # for each end the earliest start whose sum is not above its own
    starts = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = int(np.argmax(np.arange(len(total)) - starts))
    return int(starts[end]), end


def masks_for(lengths: list[int]) -> list[Mask]:
    """The masks' counted positions. For item lengths below the longest mask also all positions, and all but one, so that one substitution is met anywhere."""
    found = {tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS}
    for n in lengths:
        if MIN_ITEM_TOKENS <= n < _SPAN:
            found |= {tuple(range(n)), *(tuple(i for i in range(n) if i != k) for k in range(n))}
    return sorted(found)


def masked(tokens: np.ndarray, mask: Mask) -> np.ndarray:
    """The masked hash at each position from which the mask fits."""
    size = max(0, len(tokens) - mask[-1])
    key = np.full(size, sum(1 << i for i in mask), np.uint64)
    for i in mask:
        key = (key ^ tokens[i : i + size]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return mix(key)


def _whole(tokens: np.ndarray) -> np.ndarray:
    """The hash of all tokens of a short text."""
    return masked(tokens, tuple(range(len(tokens)))) ^ np.uint64(1)


def seeds_of(tokens: np.ndarray, masks: list[Mask]) -> np.ndarray:
    """An item's distinct seed hashes."""
    if len(tokens) < MIN_ITEM_TOKENS:
        return _whole(tokens) if len(tokens) else np.zeros(0, np.uint64)
    return np.unique(np.concatenate([masked(tokens, m) for m in masks]))


class Filter:
    """A Bloom filter of seed hashes with three probes."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(8 * len(words) - 1)

    @staticmethod
    def probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        for k in range(3):
            yield (keys >> np.uint64(18 * k)) & np.uint64(bits - 1)

    def some(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys may be in it."""
        at = np.arange(len(keys))
        for k in range(3):
            place = (keys[at] >> np.uint64(18 * k)) & self.mask
            at = at[self.words[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1]
        return at


def _filter(seeds: DataFrame, n: int) -> Filter:
    """The filter of all seeds, built in parts of _CHUNK bits; its size is bounded, so it can go to the driver and the tasks."""
    bits = min(FILTER_BITS, max(_CHUNK, 1 << (64 * n).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            found = np.unique(np.concatenate(list(Filter.probes(keys, bits)))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found // _CHUNK), pa.array(found % _CHUNK)], names=["chunk", "bit"])

    def packed(group: pa.Table) -> pa.Table:
        flags = np.zeros(_CHUNK, bool)
        flags[group.column("bit").to_numpy()] = True
        return pa.table({"chunk": group.column("chunk")[:1], "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    words = np.zeros(bits // 8, np.uint8)
    for chunk, part in seeds.select("h").mapInArrow(places, "chunk long, bit long").distinct().groupBy("chunk").applyInArrow(packed, "chunk long, bits binary").toPandas().itertuples(index=False):
        words[chunk * _CHUNK // 8 : (chunk + 1) * _CHUNK // 8] = np.frombuffer(part, np.uint8)
    return Filter(words)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, tokens) of the distinct items with tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text", _SLICE):
            tokens, counts = token_hashes(part)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item_id", "tokens"])

    known = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return materialise(known.mapInArrow(run, "item_id long, tokens array<long>").where(F.size("tokens") > 0).withColumn("item", F.monotonically_increasing_id()))


def _seeds(items: DataFrame, masks: list[Mask]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = seeds_of(tokens.values.to_numpy().view(np.uint64), masks)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), item)), pa.array(found.view(np.int64))], names=["item", "h"])

    return materialise(items.select("item", "tokens").mapInArrow(run, "item long, h long"))


def _carriers(documents: DataFrame, masks: list[Mask], known: Filter) -> DataFrame:
    """(row, doc_id, text_key, tokens, hits) of the documents that may have a seed; hits are distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text", _SLICE):
            tokens, counts = token_hashes(part)
            ends = np.cumsum(counts)
            owner, left = np.repeat(np.arange(len(counts)), counts), np.repeat(ends, counts) - np.arange(len(tokens))
            who, keys = [], []
            for mask in masks:
                own = masked(tokens, mask)
                at = known.some(own)
                at = at[left[at] > mask[-1]]
                who.append(owner[at])
                keys.append(own[at])
            for i in np.flatnonzero((counts > 0) & (counts < MIN_ITEM_TOKENS)).tolist():
                who.append(np.array([i]))
                keys.append(_whole(tokens[ends[i] - counts[i] : ends[i]]))
            who, keys = np.concatenate(who), np.concatenate(keys)
            if not len(who):
                continue
            order = np.lexsort((keys, who))
            who, keys = who[order], keys[order]
            new = np.concatenate([[True], (who[1:] != who[:-1]) | (keys[1:] != keys[:-1])])
            who, keys = who[new], keys[new]
            have = np.unique(who)
            hits = pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.append(have, len(counts))).astype(np.int32)), pa.array(keys.view(np.int64)))
            texts = pa.array([tokens[ends[i] - counts[i] : ends[i]].view(np.int64) for i in have.tolist()], pa.list_(pa.int64()))
            at = pa.array(have)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), texts, hits], names=["doc_id", "text_key", "tokens", "hits"])

    texts = text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("text").cast("string").alias("text"))
    return materialise(texts.mapInArrow(run, "doc_id long, text_key long, tokens array<long>, hits array<long>").withColumn("row", F.monotonically_increasing_id()))


def diagonals(text: np.ndarray, item: np.ndarray, masks: list[Mask]) -> np.ndarray:
    """Position in the text less position in the item of every seed that the two share, rising.

    A seed that recurs at many places of both, as in a text of one word, is
    not paired place by place: its differences come from a correlation.
    """
    found = np.zeros(len(text) + len(item) + 1, bool)
    for mask in masks:
        a, b = masked(text, mask), masked(item, mask)
        same = np.flatnonzero(np.isin(a, b))
        for key in np.unique(a[same]) if len(same) else ():
            x, y = np.flatnonzero(a == key) if len(same) > 64 else same[a[same] == key], np.flatnonzero(b == key)
            if len(x) * len(y) <= _PAIRS:
                found[(x[:, None] - y[None, :] + len(item)).ravel()] = True
            else:
                size = 1 << (len(text) + len(item)).bit_length()
                left, right = np.zeros(size), np.zeros(size)
                left[x], right[len(item) - y] = 1, 1
                found |= (np.fft.irfft(np.fft.rfft(left) * np.fft.rfft(right), size) > 0.5)[: len(found)]
    return np.flatnonzero(found) - len(item)


def overlap(text: np.ndarray, item: np.ndarray, masks: list[Mask]) -> tuple[int, int, int, int] | None:
    """(equal tokens, length, start in the text, start in the item) of the best overlap: most equal tokens, then shortest, then first."""
    if len(item) < MIN_ITEM_TOKENS:
        return (len(item), len(item), 0, 0) if np.array_equal(text, item) else None
    best = None
    for shift in diagonals(text, item, masks).tolist():
        low, high = max(shift, 0), min(shift + len(item), len(text))
        start, end = best_overlap(text[low:high] == item[low - shift : high - shift])
        if end - start >= min(MIN_TOKENS, len(item)):
            row = (-int((text[low + start : low + end] == item[low + start - shift : low + end - shift]).sum()), end - start, low + start, low + start - shift)
            best = row if best is None else min(best, row)
            if best[0] == -len(item):  # a whole item; later diagonals start later
                break
    return None if best is None else (-best[0], *best[1:])


def _found(documents: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """FOUND with row and text_key; None where the benchmark has no tokens."""
    items = _items(benchmark)
    lengths = [r[0] for r in items.where(F.size("tokens") < _SPAN).select(F.size("tokens")).distinct().collect()]
    masks = masks_for(lengths)
    seeds = _seeds(items, masks)
    if not (n := seeds.count()):
        return None
    carriers = _carriers(documents, masks, _filter(seeds, n))
    pairs = carriers.select("row", F.explode("hits").alias("h")).join(seeds, "h").select("row", "item").distinct()
    groups = -(-items.count() // ITEMS_AT_ONCE)
    own = pairs.join(items, "item").groupBy("row", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group")).agg(F.collect_list(F.struct("item_id", "tokens")).alias("items"))
    names = "row long, text_key long, " + FOUND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                text = batch.column(3)[k].values.to_numpy().view(np.uint64)
                for item in batch.column(4)[k]:
                    tokens = item["tokens"].values.to_numpy().view(np.uint64)
                    if got := overlap(text, tokens, masks):
                        equal, length, start, item_start = got
                        rows.append((batch.column(0)[k].as_py(), batch.column(2)[k].as_py(), batch.column(1)[k].as_py(), item["item_id"].as_py(), start, item_start, length, equal, len(tokens)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[c.split()[0] for c in names.split(", ")])

    joined = own.join(carriers.select("row", "doc_id", "text_key", "tokens"), "row").select("row", "doc_id", "text_key", "tokens", "items")
    return materialise(joined.mapInArrow(run, names))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item whose tokens overlap, with the best overlap.

    An overlap is a run of positions on one diagonal where substitutions are at
    most a fifth, of MIN_TOKENS tokens at least or of the whole item. The longest
    run of the diagonal counts, and substitutions may stand at its edges. It is
    found from any seed the two share; items shorter than the longest mask have
    seeds that leave out any one position, items of under MIN_ITEM_TOKENS are
    found only as whole documents.

    Documents keep the seeds that pass a filter of bounded size; these are
    joined with the benchmark's by hash, as distinct seeds of documents and
    items, so a word that recurs within either costs one row. Only what shares
    a seed is verified, ITEMS_AT_ONCE items of a document at a time.

    Null and empty texts and items never match; repeated documents are reported
    each for itself, repeated items once; rows of the benchmark that share an
    item_id are one item; further columns are ignored. Either table empty: no
    rows.
    """
    found = _found(documents, benchmark)
    if found is None:
        return documents.sparkSession.createDataFrame([], FOUND)
    order = F.struct((-F.col("n_equal")).alias("less"), "n_tokens", "doc_start", "item_start", "item_tokens", "doc_id", "n_equal")
    return found.groupBy("row", "item_id").agg(F.min(order).alias("b")).select("b.doc_id", "item_id", "b.doc_start", "b.item_start", "b.n_tokens", "b.n_equal", "b.item_tokens")


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without the rows that overlap any benchmark item, as leaks() finds them. All columns stay.

    Rows are told by doc_id and text, nulls too. The ids to drop are broadcast
    where their counted number allows.
    """
    found = _found(documents, benchmark)
    if found is None:
        return documents
    gone = materialise(found.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    same = documents["doc_id"].cast("long").eqNullSafe(gone["_gone_id"]) & (F.xxhash64(documents["text"].cast("string")) == gone["_gone_key"])
    return documents.join(gone, same, "left_anti")
