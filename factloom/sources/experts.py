"""Experts' marks from CSV files whose headings differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx


def roles(headings: Sequence[str]) -> dict[str, str]:
    """The heading of each role: the first, not yet taken, that holds one of the role's aliases, tried in their order."""
    left, out = {h: h.strip().lower() for h in headings}, {}
    for role, aliases in lx.COLUMN_ALIASES:
        fits = next((h for alias in aliases for h, name in left.items() if alias in name), None)
        if fits is not None:
            out[role] = fits
            del left[fits]
    return out


def _clean(text: Column) -> Column:
    """Without white space at its ends; null where nothing is left."""
    return F.nullif(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))


def read_experts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(case_id, category, score, note, file, order, bad) of all rows of the files.

    Each file's columns are told by its headings; one without a case, or
    without both category and score, is an error that names the file. Rows that
    don't fit the heading, or whose score is no number, keep their place with
    bad: the raw row. A decimal comma is a point. Rows without a case are left
    out unless they are bad. order is the place in the file, for last-wins.
    """
    out = None
    for path in paths:
        head = spark.read.text(path).limit(1).collect()
        separator = ";" if head and head[0][0].count(";") > head[0][0].count(",") else ","
        options = {"header": True, "sep": separator, "multiLine": True, "escape": '"', "mode": "PERMISSIVE"}
        names = spark.read.options(**options).csv(path).columns
        found = roles(names)
        if "case_id" not in found or not {"category", "score"} & found.keys():
            raise ValueError(f"{path}: no column for the case, or none for category or score, in {names}")
        # by place, since headings may repeat or hold dots
        schema = ", ".join(f"c{k} string" for k in range(len(names))) + ", _raw string"
        rows = spark.read.options(**options, columnNameOfCorruptRecord="_raw", enforceSchema=True).schema(schema).csv(path)
        of = lambda role: _clean(F.col(f"c{names.index(found[role])}")) if role in found else F.lit(None).cast("string")  # noqa: E731, B023
        score = F.replace(of("score"), F.lit(","), F.lit(".")).try_cast("double")
        own = rows.select(of("case_id").alias("case_id"), of("category").alias("category"), score.alias("score"), of("note").alias("note"), F.lit(path).alias("file"), F.monotonically_increasing_id().alias("order"), F.coalesce(F.col("_raw"), F.when(of("score").isNotNull() & score.isNull(), F.concat_ws(separator, *(f"c{k}" for k in range(len(names)))))).alias("bad"))
        own = own.where("case_id IS NOT NULL OR bad IS NOT NULL")
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no files")
    return out
