"""Similarity of a text and its reference by their longest common subsequence of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.text import lcs, words


def tokens(text: Column) -> Column:
    return words(F.coalesce(text, F.lit("")), lx.TOKEN)


def rouge_l(rows: DataFrame, reference: str, candidate: str) -> DataFrame:
    """rows with lcs, precision, recall and f1 (unrounded; 0 where a side has no tokens)."""
    out = rows.withColumns({"_r": tokens(F.col(reference)), "_c": tokens(F.col(candidate))})
    out = out.withColumn("lcs", lcs(F.col("_r"), F.col("_c")))
    share = lambda c: F.coalesce(F.try_divide(F.col("lcs"), F.size(c)), F.lit(0.0))
    out = out.withColumns({"precision": share("_c"), "recall": share("_r")})
    f1 = F.coalesce(F.try_divide(2 * F.col("lcs"), F.when(F.col("lcs") > 0, F.size("_r") + F.size("_c"))), F.lit(0.0))
    return out.withColumn("f1", f1).drop("_r", "_c")
