"""Quality rules from repetition coverage: rolling hashes of several n-gram lengths, and repeated lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, words_of

# A word is a run of anything but these white-space characters.
_WORD_CHAR, _NO_WORD_CHAR = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BASE_NGRAM = 3
MAX_REPEAT_WORDS = 0.5
#: Largest share of a text's word characters inside later copies of n-grams, by n.
MAX_NGRAM_COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_DUP_LINES = 0.30
MAX_DUP_LINE_CHARS = 0.20

COLUMNS = {"doc_id": "long", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "dup_line_chars": "long", "dup_ngram_chars": "array<long>"}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
_BASE = np.uint64(0x9E3779B97F4A7C15)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, some = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    some[order[1:]] |= same
    some[order[:-1]] |= same
    return some, later


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of size positions lie in one of the windows of n positions that begin at starts."""
    edge = np.zeros(size + n + 1, np.int64)
    edge[starts] = 1
    total = np.cumsum(edge)
    return total[:size] - np.concatenate([np.zeros(n, np.int64), total[: size - n]])[:size] > 0 if size > n else np.full(size, bool(len(starts)))


def _lines(texts: pa.StringArray) -> dict[str, np.ndarray]:
    """Lines with a word, those among them that equal an earlier one, and these lines' word characters."""
    lists = pc.split_pattern(texts, "\n")
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    codes, distinct, n_texts = flat.indices.to_numpy(), flat.dictionary, len(texts)
    owner = np.repeat(np.arange(n_texts), np.diff(ends))
    full = pc.match_substring_regex(distinct, _WORD_CHAR).to_numpy(zero_copy_only=False)[codes]
    owner, codes = owner[full], codes[full]
    _, later = repeated(owner * len(distinct) + codes)
    again = np.unique(codes[later])
    chars = np.zeros(len(distinct), np.int64)
    chars[again] = pc.utf8_length(pc.replace_substring_regex(distinct.take(pa.array(again)), _NO_WORD_CHAR, "")).to_numpy()
    count = lambda who, weights=None: np.bincount(who, weights, n_texts).astype(np.int64)
    return {"n_lines": count(owner), "n_dup_lines": count(owner[later]), "dup_line_chars": count(owner[later], chars[codes[later]])}


def measure(texts: pa.StringArray, lengths: tuple[int, ...] = tuple(MAX_NGRAM_COVERAGE)) -> dict[str, np.ndarray]:
    """Every text's counts; ngram_chars has a column for each of the rising lengths.

    A rolling hash gives each window of n words its key. Longer n-grams are
    looked for only where the n-gram one step shorter repeats, since each part
    of a repeated n-gram repeats too.
    """
    codes, counts, distinct = words_of(texts)
    size, n_texts = len(codes), len(texts)
    hashes = mix(np.arange(len(distinct), dtype=np.uint64))[codes]
    chars = pc.utf8_length(distinct).to_numpy()[codes].astype(np.int64)
    owner = np.repeat(np.arange(n_texts), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(size)
    total = lambda weights: np.bincount(owner, weights, n_texts).astype(np.int64)
    rolled, at, done = hashes + mix(owner.astype(np.uint64), 7), np.arange(size), 1
    out = {"n_words": counts, "word_chars": total(chars)}
    ngram_chars = []
    for n in (BASE_NGRAM, *lengths):
        at = at[left[at] >= n]
        key = rolled[at]
        for k in range(done, n):
            key = key * _BASE + hashes[at + k]
        rolled[at], done = key, n
        some, later = repeated(key)
        if n == BASE_NGRAM:
            out["n_repeat_words"] = total(covered(at[some], n, size))
        else:
            ngram_chars.append(total(covered(at[later], n, size) * chars))
        at = at[some]
    out["ngram_chars"] = np.stack(ngram_chars, axis=1) if ngram_chars else np.zeros((n_texts, 0), np.int64)
    out["n_symbols"] = sum(pc.count_substring(texts, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in SYMBOLS)
    return out | _lines(texts)


def judge(documents: DataFrame) -> DataFrame:
    """One row a document: counts over its whole text, the base rules' verdict and the final one.

    A text fails the base rules with fewer than MIN_WORDS words or with over
    half of its words in repeated 3-word windows. It is kept unless it fails
    them, or the share of its word characters inside later copies of n-grams
    or of lines, or the share of repeated lines, passes its limit.

    Null and empty texts have no words and fail. Repeated rows are judged each
    for itself; an empty table gives no rows; further columns are ignored. The
    work is one narrow pass, so no key can be hot; a task holds a few MB of
    text at once, or one text that is longer.
    """
    lengths = tuple(MAX_NGRAM_COVERAGE)
    limits = np.array([MAX_NGRAM_COVERAGE[n] for n in lengths])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            m = measure(texts, lengths)
            words, chars = m["n_words"], m["word_chars"]
            m["base_failed"] = (words < MIN_WORDS) | (100 * m["n_repeat_words"] > 100 * MAX_REPEAT_WORDS * words)
            over = (m["ngram_chars"] > limits * chars[:, None]).any(axis=1) | (m["n_dup_lines"] > MAX_DUP_LINES * m["n_lines"]) | (m["dup_line_chars"] > MAX_DUP_LINE_CHARS * chars)
            m |= {"kept": ~m["base_failed"] & ~over, "doc_id": batch.column(0), "dup_ngram_chars": list(m["ngram_chars"])}
            yield pa.RecordBatch.from_arrays([pa.array(m[c], type=_ARROW[k]) for c, k in COLUMNS.items()], names=list(COLUMNS))

    only = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in COLUMNS.items()))
