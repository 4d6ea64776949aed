"""Text expressions: matches with their surroundings, words, overlap of word sets."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


#: Characters that the patterns' letters match in any case though lower() says otherwise, or whose lower() has another length or depends on its surroundings.
_ODD = re.compile("[\u0130\u03a3\u1c80-\u1c88]")
_FOLDED = str.maketrans(dict(zip("\u1c80\u1c81\u1c82\u1c83\u1c84\u1c85\u1c86\u1c87\u1c88", "вдосттъ\u0463\ua64b", strict=True)))


def fold(text: str) -> tuple[str, bool]:
    """text in small letters, of the same length, for patterns in small letters (as re.IGNORECASE reads it), and whether that is just lower()."""
    if _ODD.search(text):
        return "".join(c if c == "\u0130" else c.lower() for c in text).translate(_FOLDED), False
    return text.lower(), True


def alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern at its top level."""
    out, depth, begin = [], 0, 0
    for at, c in enumerate(pattern):
        depth += (c in "([") - (c in ")]")
        if c == "|" and not depth:
            out.append(pattern[begin:at])
            begin = at + 1
    return [*out, pattern[begin:]]


def unnested(rows: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """keep and one row for each element of a computed array that is not null.

    A plain explode has the optimizer test the array's size first, for which it
    computes the array a second time.
    """
    return rows.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def squeeze(text: str) -> str:
    """Runs of white space as one space, trimmed, in lower case."""
    return re.sub(r"\s+", " ", text).strip().lower()


def squeezed(text: Column) -> Column:
    """Runs of white space as one space, trimmed, in lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def words(text: Column, pattern: str) -> Column:
    """All matches of a word pattern in the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"))


def overlap(a: Column, b: Column) -> Column:
    """Distinct words in common over the lesser number of distinct words; 0 where one side has none."""
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


@F.pandas_udf(IntegerType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of two token arrays.

    Bit-parallel: one addition on an integer of as many bits as b has tokens
    for each token of a. The table as nested folds would copy its row for every
    cell, so this one is Python on Arrow batches. A null side counts as empty.
    """

    def length(x: Sequence[str] | None, y: Sequence[str] | None) -> int:
        if x is None or y is None or not len(x) or not len(y):
            return 0
        at: dict[str, int] = {}
        for k, token in enumerate(y):
            at[token] = at.get(token, 0) | 1 << k
        full = (1 << len(y)) - 1
        left = full
        for token in x:
            hit = left & at.get(token, 0)
            left = (left + hit | left - hit) & full
        return len(y) - left.bit_count()

    return pd.Series([length(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")
