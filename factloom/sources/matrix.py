"""Wide matrices of texts, a case in each column: long pairs of a reference and its distorted candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx

#: Rows of a matrix: the source, the reference text, then the candidates.
SOURCE_ROW, GOLD_ROW = 0, 1


def legend_rows(rows: DataFrame) -> DataFrame:
    """The legend as (low, high, dtype, severity); its rows are a constant of the library, so it may be broadcast."""
    return rows.sparkSession.createDataFrame(list(lx.LEGEND), "low int, high int, dtype string, severity string")


def long_cells(matrix: DataFrame, row: str, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, case_name, row_no, text) of all cells that aren't blank; the other columns are cases. keys tell several matrices apart."""
    cases = list(columns or [c for c in matrix.columns if c != row and c not in keys])
    cells = matrix.unpivot([*keys, row], cases, "case_name", "text")
    return cells.select(*keys, "case_name", F.col(row).cast("int").alias("row_no"), F.trim(F.regexp_replace(F.col("text").cast("string"), r"^\s+|\s+$", "")).alias("text")).where("text <> ''")


def pairs(matrix: DataFrame, row: str, keys: Sequence[str] = (), reference: str = "gold") -> DataFrame:
    """(keys, case_name, row_no, pair_id, dtype, severity, reference, candidate) of every candidate that the legend names.

    Cases without a source or without a reference row are left out, and so are
    blank cells and rows beyond the legend. reference: "gold", or "source" for
    sets without a reference text. One shuffle by case joins a case's texts with
    its own reference; the legend is a range join with a constant table.
    """
    cells = long_cells(matrix, row, keys)
    by = [*keys, "case_name"]
    at = lambda n: F.max(F.when(F.col("row_no") == n, F.col("text")))
    # candidates are no part of this aggregation: two short rows a case
    known = cells.where(F.col("row_no").isin(SOURCE_ROW, GOLD_ROW)).groupBy(*by).agg(at(SOURCE_ROW).alias("source"), at(GOLD_ROW).alias("gold")).where("source IS NOT NULL AND gold IS NOT NULL")
    named = cells.join(F.broadcast(legend_rows(cells)), F.col("row_no").between(F.col("low"), F.col("high")))
    joined = named.join(known.select(*by, F.col(reference).alias("reference")), by)
    return joined.select(*by, "row_no", F.concat("case_name", F.lit("#row"), "row_no").alias("pair_id"), "dtype", "severity", "reference", F.col("text").alias("candidate"))
