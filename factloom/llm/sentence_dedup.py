"""Substring deduplication by sliding sentence spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, text_batches

#: A span is the shortest run of consecutive sentences, from its first on or back from its last, with so many sentences and words.
SPAN_SENTENCES, SPAN_WORDS = 2, 20
#: A sentence of so many words is a span by itself.
LONE_WORDS = 40
_SENTENCE = re.compile(r"[^\s.!?…](?:[^\n.!?…]|[.!?…]+(?=[^\s.!?…]))*[.!?…]*|[.!?…]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Where sentences begin and end: up to a stop before white space, or up to a line's end."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def spans(text: str, at: list[tuple[int, int]], least: int = SPAN_WORDS) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentence after the last, 128-bit hash) of the shortest spans from each sentence on and up to each sentence, in order; none where too few follow or precede."""
    plain = [text[s:e].lower().split() for s, e in at]
    n, words = len(at), np.cumsum([0, *map(len, plain)])
    first = np.arange(n)
    ends = np.maximum(np.searchsorted(words, words[:-1] + least), first + SPAN_SENTENCES)
    starts = np.minimum(np.searchsorted(words, words[1:] - least, side="right") - 1, first + 1 - SPAN_SENTENCES)
    found = {(i, j) for i, j in enumerate(ends.tolist()) if j <= n} | {(i, j) for j, i in enumerate(starts.tolist(), 1) if i >= 0}
    found |= {(i, i + 1) for i in np.flatnonzero(np.diff(words) >= LONE_WORDS).tolist()}
    joined = [" ".join(p) for p in plain]
    return [(i, j, xxhash.xxh3_128_digest("\n".join(joined[i:j]))) for i, j in sorted(found)]


def _texts(documents: DataFrame) -> DataFrame:
    return text_batches(documents).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def repeated_spans(documents: DataFrame, least: int = SPAN_WORDS) -> DataFrame:
    """(doc_id, first, last, first_doc_id) of each span that is not the first with its sentences; last is exclusive.

    The first is that of the least doc_id, and in it the earliest. Spans that
    repeat within a document are told there; the others by a count and a least
    id for each hash, which are pre-aggregated and written, and a join back of
    two written tables, so that Spark can split a hash that many documents share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), part.to_pylist(), strict=True):
                seen = set()
                for i, j, digest in spans(text, sentences(text), least):
                    rows.append((doc_id, i, j, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:12], "little", signed=True), digest in seen))
                    seen.add(digest)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()), strict=True)], names=["doc_id", "first", "last", "h", "g", "again"])

    every = materialise(_texts(documents).mapInArrow(run, "doc_id long, first int, last int, h long, g int, again boolean"))
    known = materialise(every.where("NOT again").groupBy("h", "g").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc_id")).where("n > 1").drop("n"))
    across = every.join(known, ["h", "g"]).where("doc_id <> first_doc_id").select("doc_id", "first", "last", "first_doc_id")
    within = every.where("again").select("doc_id", "first", "last", F.col("doc_id").alias("first_doc_id"))
    return across.union(within)


def _without(text: str, covered: set[int], at: list[tuple[int, int]]) -> str:
    """text without the covered sentences; the white space after a removed one goes too, line ends stay."""
    out, last = [], 0
    for k, (start, end) in enumerate(at):
        if k in covered:
            out.append(text[last:start])
            last = end
            while last < len(text) and text[last] in " \t":
                last += 1
    return "".join([*out, text[last:]]).strip(" ") if covered else text


def deduplicate(documents: DataFrame, least: int = SPAN_WORDS) -> DataFrame:
    """One row for each document that loses sentences: its new text and what was removed.

    Every sentence that a repeated span covers goes, unless the span is the
    first of its kind. removed lists them as "start:end" in code points of the
    old text, first_doc_ids the documents that keep them.

    Documents without repeats have no row. Null and empty texts have no spans.
    Rows that repeat a doc_id are one document: what only they share stays, and
    each of them loses what the document loses. Rows without a doc_id are left
    out. An empty table gives no rows;
    further columns are ignored.
    """
    found = repeated_spans(documents, least).groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias("spans"), F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"))
    schema = "doc_id long, text string, n_sentences long, n_removed long, removed string, first_doc_ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "text"):
            rows = []
            for text, own in zip(part.to_pylist(), batch.column(2).to_pylist(), strict=True):
                at = sentences(text)
                covered = {k for s in own for k in range(s["first"], min(s["last"], len(at)))}
                rows.append((_without(text, covered, at), len(at), len(covered), ",".join(f"{at[k][0]}:{at[k][1]}" for k in sorted(covered))))
            text, n, gone, removed = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, pa.string()), batch.column(3)], names=["doc_id", "text", "n_sentences", "n_removed", "removed", "first_doc_ids"])

    return _texts(documents).join(found, "doc_id").select("doc_id", "text", "spans", "first_doc_ids").mapInArrow(run, schema)
