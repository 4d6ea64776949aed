"""Comparison of named entities that some extractor found in a source and in a summary, grounded in the texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from .. import lexicons as lx
from ..functions.text import squeezed, words

ENTITIES = "array<struct<category:string,precision:double,recall:double,f1:double,in_a:int,in_b:int,matched:int,missing:array<string>,extra:array<string>>>"


@F.arrow_udf(ArrayType(StructType([StructField("a", StringType()), StructField("b", StringType())])))
def near(pairs: pa.Array) -> pa.Array:
    """Those of each row's pairs whose Ratcliff-Obershelp similarity, which has no built-in counterpart, is great enough."""
    kept = [[p for p in own or () if SequenceMatcher(None, p["a"], p["b"], autojunk=False).ratio() >= lx.ENTITY_RATIO] for own in pairs.to_pylist()]
    return pa.array(kept, pa.list_(pa.struct([("a", pa.string()), ("b", pa.string())])))


def _with_near(rows: DataFrame, asked: Column) -> DataFrame:
    """rows with _near: the alike ones of the pairs asked.

    The pairs are a column of their own and used twice, which keeps their
    lambdas out of the Python call; a call that counts as nondeterministic is
    not moved into lambdas or filters.
    """
    placed = rows.withColumn("_asked", asked)
    return placed.withColumn("_got", near.asNondeterministic()("_asked")).withColumn("_near", F.when(F.size("_asked") > 0, F.col("_got")).otherwise(F.array().cast("array<struct<a:string,b:string>>"))).drop("_asked", "_got")


def normal(name: Column) -> Column:
    """In lower case, white space squeezed, without punctuation at its ends."""
    return F.regexp_replace(squeezed(name), r"^[.,;:]+|[.,;:]+$", "")


def _telling(tokens: Column) -> Column:
    return F.array_distinct(F.filter(tokens, lambda t: F.length(t) >= 3))


def plain_match(a: Column, b: Column) -> Column:
    """Equal, one inside the other (the first longer than 3), or one's telling words all among the other's."""
    ta, tb = _telling(words(a, lx.TOKEN)), _telling(words(b, lx.TOKEN))
    subset = (F.size(ta) > 0) & (F.size(tb) > 0) & ((F.size(F.array_except(ta, tb)) == 0) | (F.size(F.array_except(tb, ta)) == 0))
    inside = (F.length(a) > 3) & (b.contains(a) | a.contains(b))
    return (a != "") & (b != "") & ((a == b) | inside | subset)


def _possible(a: Column, b: Column) -> Column:
    """Whether the lengths allow the least similarity."""
    return (a != "") & (b != "") & (2 * F.least(F.length(a), F.length(b)) >= lx.ENTITY_RATIO * (F.length(a) + F.length(b)))


def matches(names: DataFrame) -> DataFrame:
    """names (a, b) with match. Only pairs that fail the plain tests, and whose lengths allow the ratio, reach Python."""
    a, b = normal(F.col("a")), normal(F.col("b"))
    plain = F.coalesce(plain_match(a, b), F.lit(False))
    none = F.array().cast("array<struct<a:string,b:string>>")
    tested = _with_near(names.withColumn("_plain", plain), F.when(~F.col("_plain") & _possible(a, b), F.array(F.struct(a.alias("a"), b.alias("b")))).otherwise(none))
    return tested.select(*names.columns, (F.col("_plain") | (F.size("_near") > 0)).alias("match"))


def same_stem(a: Column, b: Column) -> Column:
    """Whether two words share a beginning of all but two letters of the shorter one, three letters at least."""
    n = F.greatest(F.lit(3), F.least(F.length(a), F.length(b)) - 2)
    return (F.least(F.length(a), F.length(b)) >= n) & (F.left(a, n) == F.left(b, n))


def present(name: Column, tokens: Column) -> Column:
    """Whether each of a name's telling words (those that frame it left out, if others are left) has a word of its stem among a text's tokens."""
    own = words(name, lx.TOKEN)
    long = F.filter(own, lambda t: F.length(t) >= 3)
    core = F.filter(long, lambda t: ~t.isin(*lx.FRAMING_WORDS))
    asked = F.when(F.size(core) > 0, core).when(F.size(long) > 0, long).otherwise(own)
    return (F.size(asked) > 0) & F.forall(asked, lambda t: F.exists(tokens, lambda x: same_stem(t, x)))


_TOKEN, _SPACE = re.compile(lx.TOKEN), re.compile(r"[^\S\x1c-\x1f]+")  # the white space of (?U)\s
_FRAMING, _GENERIC = frozenset(lx.FRAMING_WORDS), frozenset(lx.GENERIC_ENTITY_WORDS)


@lru_cache(1 << 14)
def _normal(name: str) -> str:
    """normal, of one name."""
    return _SPACE.sub(" ", name).strip(" ").lower().strip(".,;:")


@lru_cache(1 << 14)
def _words(name: str) -> tuple[str, ...]:
    return tuple(_TOKEN.findall(name.lower()))


@lru_cache(1 << 14)
def _asked(name: str) -> tuple[str, ...]:
    """The words of a name that a text must have, see present."""
    long = [t for t in _words(name) if len(t) >= 3]
    return tuple([t for t in long if t not in _FRAMING] or long or _words(name))


@lru_cache(1 << 16)
def _alike(a: str, b: str) -> bool:
    """plain_match, or similar enough."""
    if not a or not b:
        return False
    if a == b or len(a) > 3 and (a in b or b in a):
        return True
    x, y = ({t for t in _words(n) if len(t) >= 3} for n in (a, b))
    if x and y and (x <= y or y <= x):
        return True
    return 2 * min(len(a), len(b)) >= lx.ENTITY_RATIO * (len(a) + len(b)) and SequenceMatcher(None, a, b, autojunk=False).ratio() >= lx.ENTITY_RATIO


#: So many words are looked for in a text as it is, before its own words are put in order.
_LOOKED_FOR = 200
_IN_TOKENS = frozenset("абвгдежзийклмнопрстуфхцчшщъыьэюяёabcdefghijklmnopqrstuvwxyz0123456789")


def _same(t: str, x: str) -> bool:
    """same_stem, of two words with the same first three letters."""
    least = min(len(t), len(x))
    n = max(3, least - 2)
    return least >= n and t[:n] == x[:n]


class _Text:
    """The words of a text, which are looked for by their first three letters, as words of one stem share these."""

    def __init__(self, text: str | None):
        self.low = text.lower() if text else ""
        self.asked: dict[str, bool] = {}
        self.by_stem: dict[str, set[str]] | None = None

    @property
    def empty(self) -> bool:
        return not _TOKEN.search(self.low)

    def has_all(self, names: list[_Name]) -> bool:
        for own in names:
            if own.normal is not None and not self.holds(own.asked):
                return False
        return True

    def has(self, name: str) -> bool:
        """present, of one name."""
        return self.holds(_asked(name))

    def holds(self, asked: tuple[str, ...]) -> bool:
        for t in asked:
            if t not in self.asked:
                self.asked[t] = len(t) >= 3 and (self._begins(t) if len(self.asked) < _LOOKED_FOR else self._listed(t))
            if not self.asked[t]:
                return False
        return bool(asked)

    def _begins(self, t: str) -> bool:
        at = self.low.find(t)
        if at >= 0 and (not at or self.low[at - 1] not in _IN_TOKENS):
            return True
        at = self.low.find(t[:3])
        while at >= 0:
            if (not at or self.low[at - 1] not in _IN_TOKENS) and _same(t, _TOKEN.match(self.low, at)[0]):
                return True
            at = self.low.find(t[:3], at + 1)
        return False

    def _listed(self, t: str) -> bool:
        if self.by_stem is None:
            self.by_stem = {}
            for x in _TOKEN.findall(self.low):
                self.by_stem.setdefault(x[:3], set()).add(x)
        return any(_same(t, x) for x in self.by_stem.get(t[:3], ()))


_Told = tuple[int, int, int, list[str], list[str]]


class _Name(NamedTuple):
    """A name as it is, normal, and the words that a text must have."""

    raw: str | None
    normal: str | None
    asked: tuple[str, ...]


@lru_cache(1 << 14)
def _name(raw: str | None) -> _Name:
    return _Name(None, None, ()) if raw is None else _Name(raw, own := _normal(raw), _asked(own))


def _paired(a: Sequence[_Name], b: Sequence[_Name], x: _Text, y: _Text) -> _Told:
    """in_a, in_b, matched, missing and extra of the names of one category."""
    a, b = ([own for own in names if text.holds(own.asked)] if names and not text.empty else list(names) for names, text in ((a, x), (b, y)))
    free, missing, n = list(b), [], 0
    for raw, name, asked in a:
        if name is None:
            continue
        j = next((j for j, own in enumerate(free) if own.normal is not None and _alike(name, own.normal)), None)
        if j is not None:
            del free[j]
            n += 1
        elif not y.holds(asked):
            missing.append(raw)
    return len(a), len(b), n, missing, [own.raw for own in free if own.normal is not None and not x.holds(own.asked)]


TOLD = ArrayType(StructType([*(StructField(c, IntegerType()) for c in ("in_a", "in_b", "matched")), *(StructField(c, ArrayType(StringType())) for c in ("missing", "extra"))]))


_NONE: _Told = (0, 0, 0, [], [])


def _known(texts: pa.Array, read: Callable) -> list:
    """What is read from each text, from equal ones but once."""
    coded = texts.dictionary_encode()
    own = [read(text) for text in (*coded.dictionary.to_pylist(), None)]
    return [own[k] for k in pc.fill_null(coded.indices, -1).to_pylist()]


class _Column:
    """Names by row, from maps of category to names."""

    def __init__(self, names: pa.MapArray):
        self.maps = names.offsets.to_pylist()
        for k in np.flatnonzero(names.is_null().to_numpy(zero_copy_only=False)).tolist():
            self.maps[k + 1] = self.maps[k]
        self.keys = _known(names.keys, lambda key: key)
        self.lists = [0, *accumulate(pc.fill_null(pc.list_value_length(names.items), 0).to_pylist())]
        self.names: list[_Name] = _known(names.items.flatten(), _name)

    def all(self, row: int) -> list[_Name]:
        return self.names[self.lists[self.maps[row]] : self.lists[self.maps[row + 1]]]

    def by_category(self, row: int) -> dict[str, list[_Name]]:
        return {self.keys[k]: self.names[self.lists[k] : self.lists[k + 1]] for k in range(self.maps[row], self.maps[row + 1])}


def _told(a: dict[str, list[_Name]], b: dict[str, list[_Name]], x: _Text, y: _Text) -> list[_Told]:
    """What becomes of the names by category."""
    sides = ((a.get(c, ()), b.get(c, ())) for c in lx.ENTITY_CATEGORIES)
    return [_paired(own, other, x, y) if own or other else _NONE for own, other in sides]


@F.arrow_udf(TOLD)
def told(names_a: pa.Array, names_b: pa.Array, source: pa.Array, summary: pa.Array) -> pa.Array:
    """What becomes of the names of each category, see compared."""
    a, b = _Column(names_a), _Column(names_b)
    texts = zip(map(_Text, source.to_pylist()), map(_Text, summary.to_pylist()), strict=True)
    rows = [r for k, (x, y) in enumerate(texts) for r in _told(a.by_category(k), b.by_category(k), x, y)]
    kinds = [pa.int32()] * 3 + [pa.list_(pa.string())] * 2
    flat = pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], TOLD.elementType.names)
    return pa.ListArray.from_arrays(pa.array([k * len(lx.ENTITY_CATEGORIES) for k in range(len(names_a) + 1)], pa.int32()), flat)


@lru_cache(1 << 14)
def _of_substance(name: str) -> bool:
    """See changed."""
    return any(len(t) >= 4 and t not in _GENERIC for t in _words(name))


LOST = StructType([StructField("missing", ArrayType(StructType([StructField("category", StringType()), StructField("name", StringType())]))), StructField("changed", BooleanType())])


@F.arrow_udf(LOST)
def lost(names_a: pa.Array, names_b: pa.Array, source: pa.Array, summary: pa.Array) -> pa.Array:
    """The missing names, and changed, of what told tells. Nothing is lost where each text has all names of the other, which then need no partners."""
    a, b = _Column(names_a), _Column(names_b)
    missing, ends, changed_ = [], [0], []
    for k, (x, y) in enumerate(zip(map(_Text, source.to_pylist()), map(_Text, summary.to_pylist()), strict=True)):
        if y.has_all(a.all(k)) and x.has_all(b.all(k)):
            ends.append(len(missing))
            changed_.append(False)
            continue
        own = _told(a.by_category(k), b.by_category(k), x, y)
        missing += ((category, name) for category, t in zip(lx.ENTITY_CATEGORIES, own, strict=True) for name in t[3])
        changed_.append(any(_of_substance(name) for t in own for name in (*t[3], *t[4])))
        ends.append(len(missing))
    named = pa.StructArray.from_arrays([pa.array([m[k] for m in missing], pa.string()) for k in (0, 1)], ["category", "name"])
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), named), pa.array(changed_, pa.bool_())], LOST.names)


def lost_names(source: str, summary: str) -> Column:
    """struct<missing array<struct<category, name>>, changed>: what compared tells as missing, and whether names changed."""
    return lost.asNondeterministic()("entities_a", "entities_b", F.col(source), F.col(summary))


def compared(pairs: DataFrame, source: str | None = None, summary: str | None = None) -> DataFrame:
    """pairs with entities (see ENTITIES), from entities_a and entities_b, maps of category to names.

    With texts, names that are not in their own text are left out first, and a
    name of one side without a partner is neither missing nor extra where the
    other side's text has it. Names are paired first-fit in their order, each
    once. An empty side: recall 1 without names in a; precision 1 without names
    in b if a has none either, else 0. Every row is done in place, no shuffle:
    names are told apart in one pass over Arrow batches. Null maps and texts are
    empty; a null name has no partner and no place in a text.
    """
    text = lambda name: F.col(name) if name else F.lit(None).cast("string")
    listed = pairs.withColumn("_found", told.asNondeterministic()("entities_a", "entities_b", text(source), text(summary)))
    named = F.zip_with("_found", F.array(*map(F.lit, lx.ENTITY_CATEGORIES)), lambda e, c: F.struct(c.alias("category"), *(e[f].alias(f) for f in TOLD.elementType.names)))
    done = listed.withColumn("_told", named)
    recall = lambda e: F.when(e["in_a"] > 0, (e["in_a"] - F.size(e["missing"])) / e["in_a"]).otherwise(1.0)
    precision = lambda e: F.when(e["in_b"] > 0, (e["in_b"] - F.size(e["extra"])) / e["in_b"]).when(e["in_a"] == 0, 1.0).otherwise(0.0)
    f1 = lambda e: F.coalesce(F.try_divide(2 * precision(e) * recall(e), precision(e) + recall(e)), F.lit(0.0))
    full = F.transform("_told", lambda e: F.struct(e["category"].alias("category"), F.round(precision(e), 3).alias("precision"), F.round(recall(e), 3).alias("recall"), F.round(f1(e), 3).alias("f1"), e["in_a"].alias("in_a"), e["in_b"].alias("in_b"), e["matched"].alias("matched"), e["missing"].alias("missing"), e["extra"].alias("extra")))
    return done.withColumn("entities", full).drop("_found", "_told")


def changed(entities: Column) -> Column:
    """Whether a name of substance is missing or extra: one with a word of four letters or more that is not generic."""
    word = lambda t: (F.length(t) >= 4) & ~t.isin(*lx.GENERIC_ENTITY_WORDS)
    return F.exists(entities, lambda e: F.exists(F.concat(e["missing"], e["extra"]), lambda x: F.exists(words(x, lx.TOKEN), word)))
