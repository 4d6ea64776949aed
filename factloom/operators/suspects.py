"""Which pairs of texts can have facts that differ, told from their clauses for all pairs of a batch at once."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .facts import CUTS, Clause, Found, Read, clause, read


class Suspects(NamedTuple):
    """By pair, false only where there is nothing to find; links tell whether a text may have causal links."""

    texts: _Texts

    numbers: np.ndarray
    units: np.ndarray
    polarities: np.ndarray
    claims: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray

    def places(self) -> list[int]:
        return np.flatnonzero(self.numbers | self.units | self.polarities | self.claims).tolist()


class _Texts:
    """The sources and then the summaries of a batch, as facts.read reads them: row, place and number of each clause that holds something."""

    def __init__(self, source: pa.Array, summary: pa.Array):
        self.texts = cut = pc.fill_null(pa.concat_arrays([side.cast(pa.large_string()) for side in (source, summary)]), "")  # both may be over 2 GB
        for written, marked in CUTS:
            cut = pc.replace_substring(cut, written, marked)
        parts = pc.split_pattern(cut, "\0")
        coded = parts.flatten().dictionary_encode()
        self.clauses = [clause(text) for text in coded.dictionary.to_pylist()]
        own, count = coded.indices.to_numpy(), pc.list_value_length(parts).to_numpy()
        ends = np.cumsum(pc.utf8_length(coded.dictionary).to_numpy()[own] + 1, dtype=np.int64)
        first = np.concatenate([[0], ends])[np.cumsum(count) - count]
        row, place = np.repeat(np.arange(len(count)), count), np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        kept = self._test(lambda c: True)[own]
        self.row, self.own, place = row[kept], own[kept], (place - np.repeat(first, count))[kept]
        self.at = np.searchsorted(self.row, np.arange(len(count) + 1)).tolist()
        self.held = list(zip(place.tolist(), map(self.clauses.__getitem__, self.own.tolist()), strict=True))
        self.whole = self.marked_by(lambda c: c.torn) | pc.match_substring(self.texts, "\0").to_numpy(zero_copy_only=False)
        self.claims, self.links = self.marked_by(lambda c: bool(c.claims)), self.marked_by(lambda c: c.links)
        self.marks = list(zip(self.whole.tolist(), self.claims.tolist(), self.links.tolist(), strict=True))

    def _test(self, test: Callable[[Clause], bool]) -> np.ndarray:
        return np.array([c is not None and test(c) for c in self.clauses], bool)

    def marked_by(self, test: Callable[[Clause], bool]) -> np.ndarray:
        """The texts that have such a clause."""
        out = np.zeros(len(self.texts), bool)
        out[self.row[self._test(test)[self.own]]] = True
        return out

    def facts(self, of: Callable[[Clause], Iterable[tuple[int, ...]]], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and numbers of the facts of all texts."""
        tables = [[] if c is None else list(of(c)) for c in self.clauses]
        sizes = np.array([len(t) for t in tables], np.int64)
        flat, count = np.array([f for t in tables for f in t], np.int64).reshape(-1, width), sizes[self.own]
        at = np.repeat((np.cumsum(sizes) - sizes)[self.own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.repeat(self.row, count), flat[at]

    def read(self, row: int) -> tuple[str, Read]:
        text, (whole, claims, links) = self.texts[row].as_py(), self.marks[row]
        return text, read(text) if whole else Read(self.held[self.at[row] : self.at[row + 1]], claims, links)


class _Ids(dict):
    """Things by the order in which they came."""

    def __missing__(self, thing: Hashable) -> int:
        self[thing] = len(self)
        return self[thing]


def _several(n: int, pair: np.ndarray, key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The pairs of n in which a key has more than one value."""
    out = np.zeros(n, bool)
    if len(pair):
        keys, values = int(key.max()) + 1, int(value.max()) + 1
        own = np.unique((pair * keys + key) * values + value) // values
        out[own[1:][own[1:] == own[:-1]] // keys] = True
    return out


def suspects(source: pa.Array, summary: pa.Array) -> Suspects:
    """A number differs from one of its measure only where a label of a category has several values in the pair's texts, or the only numbers of a category are two; a unit where a value has several; a statement where a predicate has both polarities.

    Pairs with a text that is one clause (see facts.read) are all suspect.
    """
    n, texts = len(source), _Texts(source, summary)
    categories, labels, values, sized, units, predicates = (_Ids() for _ in range(6))

    def coded_number(f: Found) -> tuple[int, ...]:
        return categories[f.category], -1 if f.label_key is None else labels[f.category, f.label_key], values[f.value], sized[f.category, f.value], units[f.unit]

    row, number = texts.facts(lambda c: map(coded_number, c.numbers), 5)
    pair, side = (row % n, row // n) if n else (row, row)
    named = number[:, 1] >= 0
    moved = _several(n, pair[named], number[named, 1], number[named, 2])
    cells = n * max(len(categories), 1)
    ones, values_of = [], []
    for k in (0, 1):
        cell = pair[side == k] * len(categories) + number[side == k, 0]
        ones.append(np.bincount(cell, minlength=cells) == 1)
        values_of.append(np.bincount(cell, number[side == k, 2], cells))
    moved |= (ones[0] & ones[1] & (values_of[0] != values_of[1])).reshape(n, -1).any(axis=1) if n else moved
    stated, told = texts.facts(lambda c: ((predicates[name], polarity) for name, polarity in c.polarities), 2)
    turned = _several(n, stated % n if n else stated, told[:, 0], told[:, 1])
    whole = texts.whole[:n] | texts.whole[n:]
    links, claims = texts.links, texts.claims[n:]
    return Suspects(texts, moved | whole, _several(n, pair, number[:, 3], number[:, 4]) | whole, turned | whole, claims | whole, links[:n] | whole, links[n:] | whole)
