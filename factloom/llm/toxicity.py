"""Toxicity by compression distance: window lengths under dictionaries trained on ordinary and on toxic text."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_batches

#: Every so many-th document by checksum is held out of training.
FOLDS = 5
#: The bound of the sample that a model is fitted on: texts of each class, and characters a text.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 1_500, 3_000, 20_000
#: Bytes of the dictionaries.
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 2_048
#: Bytes of a window, which ends at the next blank, and at the latest after four times as many.
WINDOW = 64
THRESHOLD = 0.5
_LEVEL, _MIN_MATCH = 5, 4
_TRAIN_WINDOW = 256
#: Bytes of the segments that make up a dictionary, and of the strings whose frequency chooses them.
_SEGMENT, _DMER = 24, 6
#: Word beginnings, from a blank on, of which toxic training text may be made.
_STEMS = range(4, 9)
_CAPPED = 10
#: Parts of the sample that calibrate in turn, each with dictionaries of the others.
PARTS = 3

SCORED = "doc_id long, held_out boolean, score double, predicted int, n_windows long, best_gain long"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: its id's checksum is divisible by FOLDS."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def windows(text: str) -> list[bytes]:
    """text in lower case, cut before a blank into windows that cover all of it."""
    raw = b" " + text.lower().replace("\n", " ").encode()
    out, at, size = [], 0, len(raw)
    while at < size:
        to = raw.find(b" ", at + WINDOW, at + 4 * WINDOW)
        to = to if to >= 0 else min(size, at + 4 * WINDOW)
        out.append(raw[at:to])
        at = to
    return out


def _apart(texts: list[str], wanted: int) -> list[str]:
    """The first texts that share no least or greatest 3-word hash with an earlier one: no copies or near copies."""
    out, seen = [], set()
    for text in texts:
        words = np.array([zlib.crc32(w.encode()) for w in text.split()] or [0], np.uint64)
        runs = words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1] * np.uint64(0xD6E8FEB86659FD93) + words[2:] if len(words) > 2 else words
        own = {int(runs.min()), int(runs.max()), int((runs * np.uint64(0xA0761D6478BD642F)).min())}
        if not own & seen:
            out.append(text)
            if len(out) == wanted:
                break
        seen |= own
    return out


def _stems(text: str) -> Counter[str]:
    """How often each word beginning occurs; over CAPPED times count as that many."""
    found = Counter(w[:n] for w in map(" {}".format, text.lower().split()) for n in _STEMS if len(w) >= n)
    return Counter({s: min(n, _CAPPED) for s, n in found.items()})


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples' end where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=_SEGMENT, d=_DMER, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(_LEVEL, source_size=WINDOW, dict_size=len(content), min_match=_MIN_MATCH, write_content_size=False, write_checksum=False)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=known)


@dataclass(frozen=True)
class Model:
    """What the tasks get: two dictionaries and a calibration, under 100 KB. Without dictionaries all texts score the base rate."""

    base_rate: float
    ordinary: bytes = b""
    toxic: bytes = b""
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()

    def scorer(self):
        """A function from texts to (scores, numbers of windows, best gains)."""
        if not self.weights:
            return lambda texts: (np.full(len(texts), self.base_rate), np.array([len(windows(t)) for t in texts], np.int64), np.zeros(len(texts), np.int64))
        features = _features(self.ordinary, self.toxic)

        def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            x, n, best = features(texts)
            z = self.weights[0] + ((x - self.centre) / self.scale) @ np.array(self.weights[1:])
            return 1 / (1 + np.exp(-np.clip(z, -30, 30))), n, best

        return run


def _features(ordinary: bytes, toxic: bytes):
    """A function from texts to features of their windows' gains: bytes that the toxic dictionary saves beside the ordinary one."""
    plain, both = _compressor(ordinary), _compressor(ordinary + toxic)

    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, ns, best = [], [], []
        for text in texts:
            parts = windows(text)
            gain = np.array([len(plain.compress(w)) - len(both.compress(w)) for w in parts], np.float64)
            n, saved, some = len(parts), np.clip(gain, 0, None).mean(), (gain >= 2).mean()
            rows.append((gain.mean(), gain.max(), np.sort(gain)[-4:].mean(), some, (gain >= 4).mean(), saved, math.log(n), math.log1p(saved * n), math.log1p(some * n)))
            ns.append(n)
            best.append(int(gain.max()))
        return np.array(rows).reshape(len(texts), -1), np.array(ns, np.int64), np.array(best, np.int64)

    return run


def _calibrate(x: np.ndarray, y: np.ndarray, base_rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic weights by Newton's method, the classes weighted to the base rate, with a small ridge."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    share = y.mean()
    weight = np.where(y == 1, base_rate / share, (1 - base_rate) / (1 - share)) / len(y)
    beta, ridge = np.zeros(z.shape[1]), 1e-3 * np.eye(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (p - y)) + ridge @ beta)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return centre, scale, beta


def _train(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The two dictionaries, trained on ordinary and on toxic text.

    The toxic dictionary is trained on contrast: of toxic texts only the word
    beginnings that are several times as frequent there as in ordinary ones, so
    that what it saves is not what any text of the language saves; where there
    are none, on the whole toxic windows. (Whole windows alone told classes
    apart far worse; the README has the figures.)
    """
    in_t, in_o, texts_t, texts_o = Counter(), Counter(), Counter(), Counter()
    for counts, of, texts in ((in_t, texts_t, toxic), (in_o, texts_o, ordinary)):
        for text in texts:
            counts.update(own := _stems(text))
            of.update(own.keys())
    words_t, words_o = (max(1, sum(len(t.split()) for t in texts)) for texts in (toxic, ordinary))
    telling = set()
    for s, n in texts_t.items():
        chance = (texts_o[s] + 1) / len(ordinary) * len(toxic)
        if n >= chance + 4 * math.sqrt(chance) + 4 and in_t[s] / words_t >= 5 * (in_o[s] + 1) / words_o:
            telling.add(s)
    contrast = []
    for text in toxic:
        found = [max((w[:n] for n in _STEMS if w[:n] in telling), key=len, default="") for w in map(" {}".format, text.lower().split())]
        if any(found):
            contrast.append("".join(found).encode())
    if not contrast:  # nothing stands out: whole toxic windows
        contrast = [w for text in toxic for w in windows(text)]
    pieces = [raw[i : i + _TRAIN_WINDOW] for raw in (t.lower().encode() for t in ordinary) for i in range(0, len(raw), _TRAIN_WINDOW)]
    return _dictionary(ORDINARY_BYTES, pieces[:: -(-len(pieces) // 20_000)]), _dictionary(TOXIC_BYTES, contrast)


def fit_texts(toxic: list[str], ordinary: list[str], base_rate: float) -> Model:
    """The model of labelled texts.

    The dictionaries learn from all of them. The calibration must not see texts
    with dictionaries that learned from them: each part of the sample is
    measured with dictionaries of the other parts.
    """
    toxic, ordinary = _apart(toxic, SAMPLE_TOXIC), _apart(ordinary, SAMPLE_ORDINARY)
    if len(toxic) < PARTS or len(ordinary) < PARTS:
        return Model(base_rate)
    learned = _train(toxic, ordinary)
    x, y = [], []
    for k in range(PARTS):
        others = [[t for i, t in enumerate(texts) if i % PARTS != k] for texts in (toxic, ordinary)]
        own = [toxic[k::PARTS], ordinary[k::PARTS]]
        x.append(_features(*_train(*others))(own[0] + own[1])[0])
        y += [1.0] * len(own[0]) + [0.0] * len(own[1])
    centre, scale, beta = _calibrate(np.concatenate(x), np.array(y), base_rate)
    return Model(base_rate, *learned, tuple(centre.tolist()), tuple(scale.tolist()), tuple(beta.tolist()))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled documents that are not held out.

    The base rate counts all of them. The texts are a bounded sample: by hash
    order of their ids, at most SAMPLE_TOXIC and SAMPLE_ORDINARY (three times
    as many are looked at, for copies among them), none over SAMPLE_CHARS.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    base_rate = counts.get(1, 0) / max(1, sum(counts.values()))
    rank = F.xxhash64("doc_id")
    found = []
    for toxic, wanted in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        ids = known.where(F.col("toxic") == toxic).orderBy(rank, "doc_id").limit(3 * wanted).select("doc_id")
        texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text").between(1, SAMPLE_CHARS))
        own = texts.join(F.broadcast(ids), "doc_id").orderBy(rank, "doc_id", "text").limit(2 * wanted)
        found.append(own.select("text").toPandas()["text"].tolist())
    return fit_texts(*found, base_rate)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row a document: score from 0 to 1 over its whole text, and predicted (score of at least THRESHOLD).

    Null and empty texts are one blank window and get its score. Repeated rows
    are scored each for itself; an empty table gives no rows; further columns
    are ignored. One narrow pass; labels, lang and source are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch, texts in slices(batches, "text"):
            p, n, best = of(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(n), pa.array(best)], names=[c.split()[0] for c in SCORED.split(", ")])

    only = text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return only.mapInArrow(run, SCORED)


def drop_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """documents without the rows that the model predicts to be toxic. Narrow; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch, texts in slices(batches, "text"):
            yield batch.filter(pa.array(of(texts.to_pylist())[0] < THRESHOLD))

    return text_batches(documents).mapInArrow(run, documents.schema)
