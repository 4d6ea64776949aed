"""Facts of a text: numbers with units, statements with polarity, causal links, claims about values.

What depends on the text left of a match is read in Arrow batches by compiled
patterns, which built-in functions cannot do: they tell no positions. All else
is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, StringType, StructField, StructType

from .. import lexicons as lx
from ..functions.text import alternatives, fold

# The patterns are written in small letters and read folded texts: without a flag for case an alternative's first letter tells where to look at all.
# Units stand side by side and not group by group, for the same reason.
_UNIT = re.compile(f"(?P<value>{lx.NUMBER})\\s?(?P<unit>{'|'.join(p for _, own in lx.UNIT_GROUPS for p in alternatives(own)).lower()})")
#: For texts without other digits, which are much the quicker to look for.
_UNIT_PLAIN = re.compile(_UNIT.pattern.replace(r"\d]", "0-9]").replace(r"\d", "[0-9]"))
_OTHER_DIGIT = re.compile(r"[^\D0-9]")
_CATEGORIES = [(name, re.compile(pattern.replace(r"\s?", ""), re.IGNORECASE)) for name, pattern in lx.UNIT_GROUPS]
_NEGATORS, _BETWEEN = re.fullmatch(r"\(\?:(.*?)\)(.*)", lx.NEGATION).groups()
#: The alternatives that begin with a negation have a group, the plain ones have none.
_PREDICATE = re.compile("|".join([*(f"{n}{_BETWEEN}({'|'.join(lx.PREDICATES)})" for n in alternatives(_NEGATORS)), *lx.PREDICATES]))
#: An empty group at the end of each alternative tells which one it is.
_ANTONYM_OF = [(name, polarity) for name, *sides in lx.ANTONYMS for polarity, side in zip((True, False), sides) for _ in alternatives(side)]
_ANTONYM = re.compile("|".join(f"{p}()" for _, *sides in lx.ANTONYMS for side in sides for p in alternatives(side)))
_CLAIM_OF = [name for name, side in lx.CLAIMS for _ in alternatives(side)]
_CLAIM = re.compile("|".join(f"{p}()" for _, side in lx.CLAIMS for p in alternatives(side)))
_VALUE = re.compile(lx.VALUE_AFTER, re.IGNORECASE)
_PERSON = re.compile(lx.PERSON, re.IGNORECASE)
_BOUNDARIES = ",;:.\n()"
_LABEL_WORD, _CONTEXT_WORD = re.compile(lx.LABEL_WORD), re.compile(lx.CONTEXT_WORD)

_TEXT, _NUMBER, _FLAG, _WORDS = StringType(), DoubleType(), BooleanType(), ArrayType(StringType())


def array_of(**fields: DataType) -> ArrayType:
    return ArrayType(StructType([StructField(name, kind) for name, kind in fields.items()]))


_ARROW = {StringType: pa.string(), DoubleType: pa.float64(), BooleanType: pa.bool_(), ArrayType: pa.list_(pa.string())}


def _lists(rows: list[list], kind: ArrayType) -> pa.Array:
    """Each row's facts as a list of structs, built column by column from their attributes."""
    ends = [0]
    for own in rows:
        ends.append(ends[-1] + len(own))
    fields = kind.elementType.fields
    columns = [pa.array([getattr(fact, f.name) for own in rows for fact in own], _ARROW[type(f.dataType)]) for f in fields]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, [f.name for f in fields]))


NUMBERS = array_of(value=_NUMBER, unit_raw=_TEXT, unit=_TEXT, category=_TEXT, label=_TEXT, label_key=_TEXT, context=_TEXT, words=_WORDS, person=_FLAG, raw=_TEXT)
STATEMENTS = array_of(predicate=_TEXT, polarity=_FLAG, context=_TEXT, words=_WORDS, raw=_TEXT)
CLAIMS = array_of(claimed=_TEXT, value=_NUMBER, second=_NUMBER, unit=_TEXT, fragment=_TEXT)
CLAIM_ARROW = pa.list_(pa.struct([("claimed", pa.string()), ("value", pa.float64()), ("second", pa.float64()), ("unit", pa.string()), ("fragment", pa.string())]))


@lru_cache(4096)
def unit_category(unit: str) -> str:
    """The first unit group that fits the unit without spaces, else "other" (so "в минуту", which needs its space, is other)."""
    plain = unit.lower().replace(" ", "")
    return next((name for name, pattern in _CATEGORIES if pattern.match(plain)), "other")


@lru_cache(4096)
def _last_words(tail: str) -> str:
    return " ".join(_LABEL_WORD.findall(tail.lower())[-2:])


def label(left: str) -> str:
    """The last two words after the last boundary left of a number."""
    return _last_words(left[max(map(left.rfind, _BOUNDARIES)) + 1 :])


@lru_cache(4096)
def label_key(name: str) -> str | None:
    """The set of a label's telling words, sorted and joined; None where none is left."""
    return " ".join(sorted(set(name.split()).difference(lx.GENERIC_LABEL_WORDS))) or None


@lru_cache(4096)
def _words(left: str) -> frozenset[str]:
    return frozenset(_CONTEXT_WORD.findall(left))


@lru_cache(4096)
def _value(digits: str) -> float:
    return float(digits.replace(",", "."))


@lru_cache(4096)
def _unit(raw: str) -> tuple[str, str]:
    """Category and plain form of a unit as written."""
    return unit_category(raw), "".join(raw.lower().split())


class _Fact:
    """A match in a text; what depends on the text left of it is read only where it is asked for."""

    __slots__ = ("text", "start", "end")
    window: int

    def left(self, window: int) -> str:
        return self.text[max(0, self.start - window) : self.start].lower()

    @property
    def context(self) -> str:
        return " ".join(self.left(self.window).split())

    @property
    def word_set(self) -> frozenset[str]:
        return _words(self.left(self.window))

    @property
    def words(self) -> list[str]:
        return sorted(self.word_set)

    @property
    def raw(self) -> str:
        return self.text[self.start : self.end].strip()


class Found(NamedTuple):
    """A number by its places within a clause."""

    start: int
    end: int
    unit_at: int
    value: float
    category: str
    unit: str
    label: str
    label_key: str | None


class Number(_Fact):
    __slots__ = ("value", "category", "unit", "unit_at", "label", "label_key")
    window = lx.NUMBER_WINDOW

    def __init__(self, text: str, at: int, own: Found):
        start, end, unit_at, self.value, self.category, self.unit, self.label, self.label_key = own
        self.text, self.start, self.end, self.unit_at = text, at + start, at + end, at + unit_at

    @property
    def unit_raw(self) -> str:
        return self.text[self.unit_at : self.end]

    @property
    def person(self) -> bool:
        return bool(_PERSON.search(self.context))


class Statement(_Fact):
    __slots__ = ("predicate", "polarity")
    window = lx.POLARITY_WINDOW

    def __init__(self, text: str, start: int, end: int, predicate: str, polarity: bool):
        self.text, self.start, self.end, self.predicate, self.polarity = text, start, end, predicate, polarity


class Clause(NamedTuple):
    """What a clause holds, by places within it."""

    numbers: tuple[Found, ...]
    measures: tuple[tuple[str, float, str], ...]  # category, value and unit, each once
    predicates: tuple[tuple[int, int, str, bool], ...]  # start, end, predicate, polarity
    antonyms: tuple[tuple[int, int, str, bool], ...]
    claims: tuple[tuple[int, int, str], ...]  # start, end, what is claimed
    polarities: tuple[tuple[str, bool], ...]
    links: bool  # whether there may be a causal link
    torn: bool  # whether a unit may go on after the clause


#: What ends a clause, and what does not, with the mark that texts are cut at.
CUTS = ((", ", ",\0"), (". ", ".\0"), ("рт.\0ст", "рт. ст"))
#: Longer clauses hardly repeat and are not kept, so that what is kept stays some tens of MB.
_KEPT = 200


@lru_cache(1 << 16)
def _clause(text: str) -> Clause | None:
    """The clause's facts, None where there are none. Clauses repeat within and between texts; each is searched once while it is kept.

    A label ends at a clause's beginning, so it is told here; what else stands
    left of a fact is not.
    """
    folded, _ = fold(text)
    numbers = []
    for m in (_UNIT if _OTHER_DIGIT.search(folded) else _UNIT_PLAIN).finditer(folded):
        start, end = m.span()
        at, name = m.start("unit"), label(text[max(0, start - lx.LABEL_WINDOW) : start].lower())
        numbers.append(Found(start, end, at, _value(m["value"]), *_unit(text[at:end]), name, label_key(name)))
    predicates = tuple((m.start(), m.end(), text[m.start(m.lastindex or 0) : m.end()].lower()[:6], m.lastindex is None) for m in _PREDICATE.finditer(folded))
    antonyms = tuple((m.start(), m.end(), *_ANTONYM_OF[m.lastindex - 1]) for m in _ANTONYM.finditer(folded))
    claims = tuple((m.start(), m.end(), _CLAIM_OF[m.lastindex - 1]) for m in _CLAIM.finditer(folded))
    polarities = tuple(dict.fromkeys(own[2:] for own in (*predicates, *antonyms)))
    links, torn = any(stem in folded for stem in lx.CAUSAL_STEMS), folded.endswith("рт.")
    return Clause(tuple(numbers), tuple(dict.fromkeys((own.category, own.value, own.unit) for own in numbers)), predicates, antonyms, claims, polarities, links, torn) if numbers or polarities or claims or links or torn else None


def clause(text: str) -> Clause | None:
    return (_clause if len(text) <= _KEPT else _clause.__wrapped__)(text)


class Read(NamedTuple):
    """The clauses of a text that hold something, with their places, and whether any has a claim or may have a causal link."""

    clauses: list[tuple[int, Clause]]
    claims: bool = False
    links: bool = False


def read(text: str | None) -> Read:
    """A text's clauses end at a full stop or comma before a space, which no pattern crosses but that of "мм рт. ст."; where such a unit is not written just so, and in texts with the mark that ends clauses here, the text is one clause."""
    if not text:
        return Read([])
    clauses, at, torn, claims, links = [], 0, "\0" in text, False, False
    cut = text
    for written, marked in CUTS:
        cut = cut.replace(written, marked)
    for piece in cut.split("\0"):
        if (own := clause(piece)) is not None:
            clauses.append((at, own))
            torn, claims, links = torn or own.torn, claims or bool(own.claims), links or own.links
        at += len(piece) + 1
    if torn:
        own = _clause.__wrapped__(text)
        return Read([(0, own)], bool(own.claims), own.links) if own is not None else Read([])
    return Read(clauses, claims, links)


def numbers(text: str | None, own: Read | None = None) -> list[Number]:
    """Numbers with units in text order. Null texts have none. own: the text as read, where it is known."""
    return [Number(text, at, number) for at, c in (own or read(text)).clauses for number in c.numbers]


def statements(text: str | None, own: Read | None = None, of: Collection[str] | None = None) -> list[Statement]:
    """Predicates with or without a negation in text order, then antonyms in text order, of some predicates or of all. One phrase may give both."""
    clauses = (own or read(text)).clauses
    found = [(k, s) for k, c in clauses for s in c.predicates] + [(k, s) for k, c in clauses for s in c.antonyms]
    return [Statement(text, k + start, k + end, name, polarity) for k, (start, end, name, polarity) in found if of is None or name in of]


def stated(own: Read) -> list[str]:
    """The predicates of statements, each once."""
    return list(dict.fromkeys(name for _, c in own.clauses for name, _ in c.polarities))


def _part(kind: ArrayType, fields: tuple[str, ...]) -> ArrayType:
    return ArrayType(StructType([kind.elementType[f] for f in fields])) if fields else kind


def numeric_fields(text: Column, *fields: str) -> Column:
    """numeric_facts with these fields alone; what only the others need is not read."""
    kind = _part(NUMBERS, fields)

    @F.arrow_udf(kind)
    def found(texts: pa.Array) -> pa.Array:
        return _lists([numbers(t) for t in texts.to_pylist()], kind)

    return found(text)


def polarity_fields(text: Column, *fields: str) -> Column:
    """polarity_facts with these fields alone."""
    kind = _part(STATEMENTS, fields)

    @F.arrow_udf(kind)
    def found(texts: pa.Array) -> pa.Array:
        return _lists([statements(t) for t in texts.to_pylist()], kind)

    return found(text)


@F.arrow_udf(NUMBERS)
def numeric_facts(texts: pa.Array) -> pa.Array:
    """Numbers with units in text order: value, unit, category, label, and the words before them. Null texts have none."""
    return _lists([numbers(text) for text in texts.to_pylist()], NUMBERS)


@F.arrow_udf(STATEMENTS)
def polarity_facts(texts: pa.Array) -> pa.Array:
    """The statements of texts: predicate, polarity and the words before them."""
    return _lists([statements(text) for text in texts.to_pylist()], STATEMENTS)


def claimed(text: str | None, own: Read | None = None) -> list[dict]:
    """Judging words with a value right after them. own: the text as read, where it is known."""
    own, out = own or read(text), []
    if not own.claims:
        return out
    for start, end, name in ((k + start, k + end, name) for k, c in own.clauses for start, end, name in c.claims):
        if v := _VALUE.match(text[end : end + lx.CLAIM_WINDOW]):
            fragment = re.sub(r"\s+", " ", f"{text[start:end]} {v[0]}".strip())[:48]
            out.append({"claimed": name, "value": float(v[1].replace(",", ".")), "second": float(v[2]) if v[2] else None, "unit": re.sub(r"\s+", "", (v[3] or "").lower()), "fragment": fragment})
    return out


@F.arrow_udf(CLAIMS)
def claims(texts: pa.Array) -> pa.Array:
    """claimed of each text."""
    return pa.array([claimed(text) for text in texts.to_pylist()], CLAIM_ARROW)


def causal_links(text: Column) -> Column:
    """The causal connectives of a text, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?iU)({lx.CAUSAL})"))


def true_polarity(value: Column, second: Column, unit: Column) -> Column:
    """low, high or normal by the reference range of an unambiguous unit, else null."""

    def within(low: float, high: float) -> Column:
        return F.when(value < low, "low").when(value > high, "high").otherwise("normal")

    pressure = F.when(second.isNull(), F.lit(None)).when((value >= 140) | (second >= 90), "high").when(value < 90, "low").otherwise("normal")
    return (
        F.when(unit.contains("ммрт"), pressure)
        .when(unit.contains("минут") | unit.startswith("уд"), within(60, 100))
        .when((unit == "г/л") & value.between(100, 200), within(120, 175))
        .when(unit.contains("мкмоль"), within(55, 115))
        .when((unit == "ед/л") & (value > 400), "high")
    )


def contradictions(text: Column) -> Column:
    """array<struct<claimed, actual, fragment>>: judging words whose value's reference range says otherwise."""
    return contradicted(claims(text))


def contradicted(found: Column) -> Column:
    """Those of the claims found that are contradictions."""
    told = F.transform(found, lambda c: F.struct(c["claimed"].alias("claimed"), true_polarity(c["value"], c["second"], c["unit"]).alias("actual"), c["fragment"].alias("fragment")))
    return F.filter(told, lambda c: c["actual"] != c["claimed"])
