"""Packing of tokenised documents into fixed windows, best fit decreasing."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, words_of

WINDOW = 4096
END_ID = 2
#: Documents a packing group holds on average: enough that its last windows, which alone stay part empty, hardly count.
DOCS_PER_GROUP = 16_384
#: Entries of one generation of a worker's cache of encoded words.
CACHED_WORDS = 500_000
#: Entries that a worker keeps from one task to the next.
KEPT_WORDS = 100_000

#: Punctuation at a word's end that the tokenizer separates from letters; no apostrophe, which it may join to them.
_CLOSING = "!\"#$%&()*+,-./:;=?@[]^_`{}~"

#: Bytes of text that are split into words at once.
SLICE = 16_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, pack_group long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_to long"


def _plain(word: str) -> bool:
    """Only letters whose lower case is one letter, which normal forms don't change."""
    return word.isalpha() and max(word) < "\u0130"


class WordEncoder:
    """Encodes texts word by word and remembers the words' ids as little-endian bytes.

    The tokenizer never joins what white space separates, so a text's ids are
    those of its words, one after the other. Two generations of the
    cache bound its memory: when the young one is full it becomes the old one.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.suffix:
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(self.suffix)]] = True

    def encode(self, texts: pa.StringArray) -> tuple[memoryview, np.ndarray]:
        """The ids of all texts, one after the other, as unsigned 32-bit little-endian bytes, and each text's number of ids."""
        codes, counts, distinct = words_of(texts)
        young, words = self.young, distinct.to_pylist()
        found = list(map(young.get, words))
        if missing := [w for w, ids in zip(words, found, strict=True) if ids is None]:
            self._learn(missing)
            found = [young[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
        if len(young) > self.cached:
            self.old, self.young = young, {}
        joined = pa.array(found, pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(codes) + 1)[np.concatenate([[0], np.cumsum(counts)])] if len(codes) else np.zeros(len(counts) + 1, np.int64)
        return memoryview(joined.buffers()[2] or b""), np.diff(ends) // 4

    def shrink(self) -> None:
        """Keeps the words met first, which are the most frequent: the worker may live on for other work."""
        self.young, self.old = dict(islice(self.young.items(), KEPT_WORDS)), {}
        pa.default_memory_pool().release_unused()

    def _learn(self, words: list[str]) -> None:
        """Puts the words into the young generation, from the old one where it has them.

        A word is looked at as letters with closing punctuation, which the
        tokenizer separates too. Only a plain last letter is cut off, and only
        plain letters are lower-cased here: the others' case mapping may add
        marks that join the punctuation.
        """
        young, old = self.young, self.old
        parts, heads = [], set()
        for w in words:
            if (ids := old.get(w)) is not None:
                young[w] = ids
                continue
            head = w.rstrip(_CLOSING)
            if head and head is not w and head.isalpha() and head[-1] < "\u0130":
                tail = w[len(head) :]
                heads.add(tail)
            else:
                head, tail = w, ""
            if _plain(head):
                head = head.lower()
            heads.add(head)
            parts.append((w, head, tail))
        fresh = []
        for w in heads:
            if w not in young:
                if (ids := old.get(w)) is not None:
                    young[w] = ids
                else:
                    fresh.append(w)
        self._raw(fresh)
        for w, head, tail in parts:
            if w not in young:
                young[w] = young[head] + young[tail] if tail else young[head]

    def _raw(self, words: list[str]) -> None:
        """Words that are letters only go to the tokenizer as one text: each is one token run up to a word end."""
        plain = list(filter(_plain, words)) if self.suffix else []
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype="<u4")
            to = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(to) == len(plain):
                raw, at = ids.tobytes(), 0
                for w, end in zip(plain, to.tolist(), strict=True):
                    self.young[w] = raw[at:end]
                    at = end
        rest = [w for w in words if w not in self.young]
        for w, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.young[w] = array("I", got.ids).tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(n_ids: int, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's full windows and of its rest."""
    for at in range(0, n_ids, window):
        yield at, min(window, n_ids - at)


class OpenWindows:
    """A segment tree over remaining capacities; a leaf holds the open windows with just that room."""

    def __init__(self, window: int = WINDOW):
        self.size = 1 << window.bit_length()
        self.some = bytearray(2 * self.size)
        self.at: dict[int, list[int]] = {}

    def add(self, room: int, window_id: int) -> None:
        if not self.at.setdefault(room, []):
            node = self.size + room
            while node and not self.some[node]:
                self.some[node] = 1
                node >>= 1
        self.at[room].append(window_id)

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest open window with room for need, taken out: (room, id)."""
        some, node = self.some, self.size + need
        if not some[node]:
            while node > 1 and (node & 1 or not some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if some[2 * node] else 2 * node + 1
        room = node - self.size
        window_id = self.at[room].pop()
        if not self.at[room]:
            while node and not (node < self.size and (some[2 * node] or some[2 * node + 1])):
                some[node] = 0
                node >>= 1
        return room, window_id


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number and offset of each length (which come in falling order), and the windows' fill."""
    numbers, offsets, fill, tree = [], [], [], OpenWindows(window)
    for need in lengths.tolist():
        found = tree.take(need)
        room, number = found or (window, len(fill))
        if found is None:
            fill.append(0)
        numbers.append(number)
        offsets.append(fill[number])
        fill[number] += need
        if room > need:
            tree.add(room - need, number)
    return np.array(numbers, dtype=np.int64), np.array(offsets, dtype=np.int64), np.array(fill, dtype=np.int64)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """One row for each piece of each document, with its place in a sequence of at most window ids.

    A document's ids are its text's, then end_id; null and empty texts have the
    end_id alone. Documents over the window are cut into full windows first, so
    only their rests are packed. Pieces are dealt over groups by a hash of the
    piece's place in its task (another split of the files deals them otherwise); a group is packed best fit
    decreasing by OpenWindows, so windows of different groups never mix and no
    task sees more than about docs_per_group documents' pieces. Ties go by
    doc_id, start and checksum. A sequence whose fill is a power of two needs
    no padding: padded_to is its fill there, else the window.

    Repeated rows are packed each for itself; an empty table gives no rows;
    further columns of docs are ignored, whatever their names.
    """
    groups = max(1, -(-docs.count() // docs_per_group))
    end = np.array([end_id], dtype="<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, encode, row = TaskContext.get().partitionId(), encoder(tokenizer_path).encode, 0
        for batch, texts in slices(batches, "text", SLICE):
            ids, counts = encode(texts)
            rows, at = [], 0
            for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                row += 1
                for start, length in cut(n + 1, window):
                    last = start + length > n
                    crc = zlib.crc32(ids[at + 4 * start : at + 4 * (start + length - last)])
                    crc = zlib.crc32(end, crc) if last else crc
                    rows.append((doc_id, start, length, crc, n + 1, zlib.crc32(b"%d.%d.%d" % (own, row, start)) % groups))
                at += 4 * n
            yield pa.RecordBatch.from_pydict({c: pa.array(x, type=pa.int64()) for c, x in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "pack_group"), zip(*rows, strict=True), strict=True)})
        encoder(tokenizer_path).shrink()

    def fill(key: tuple, pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        number, offset, used = best_fit(pieces.column("length").to_numpy(), window)
        total = used[number]
        for name, values in (("sequence_id", (key[0].as_py() << 32) + number), ("offset", offset), ("sequence_tokens", total), ("padded_to", np.where(total & (total - 1) == 0, total, window))):
            pieces = pieces.append_column(name, pa.array(values, pa.int64()))
        return pieces.drop_columns(["pack_group"])

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tokenise, PIECES)
    return pieces.groupBy("pack_group").applyInArrow(fill, PACKED)
