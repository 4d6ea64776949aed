"""Queries on word edits, and on matrices of texts with a case in each column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edits
from ..sources import matrix, tables
from . import corpus

_CASES = [f"case_{k}" for k in range(1, 8)]
_CELL = "'Part ' || l_partkey || ', quantity ' || CAST(l_quantity AS INT) || ', status ' || l_linestatus || '; returned: ' || l_returnflag"
#: A sheet for each supplier: rows by order, columns by line.
_WIDE = f"SELECT l_suppkey AS sheet, CAST(l_orderkey % 41 AS INT) AS row_label, {', '.join(f'max(CASE WHEN l_linenumber = {k} THEN cell END) AS {c}' for k, c in enumerate(_CASES, 1))} FROM (SELECT *, {_CELL} AS cell FROM lineitem) AS cells GROUP BY l_suppkey, l_orderkey % 41"


def turn_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changes from each turn of a conversation to the next; of turns with the same number the least text counts."""
    turns = tables.read(spark, sf_dir, "conversations").where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before"))
    done = edits.with_edits(turns.join(before, ["conv_id", "turn"]), "before", "text")
    return done.select("conv_id", "turn", F.size("edits").alias("n_edits"), "n_equal", F.array_join("kinds", ",").alias("kinds"))


def _matrix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus", "l_returnflag")
    wide = spark.sql(_WIDE.replace("FROM lineitem", "FROM {lines}"), lines=lines)
    return matrix.pairs(wide, "row_label", ["sheet"])


def matrix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix_pairs(spark, sf_dir).select("sheet", "case_name", "row_no", "pair_id", "dtype", "severity", "reference", "candidate")


def legend_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.legend_warnings(_matrix_pairs(spark, sf_dir))


QUERIES = {f.__name__: f for f in (turn_edits, matrix_pairs, legend_consistency)}

_CELLS = f"SELECT sheet, row_label AS row_no, name AS case_name, trim(value) AS text FROM (UNPIVOT ({_WIDE}) ON {', '.join(_CASES)} INTO NAME name VALUE value) WHERE trim(value) <> ''"
ORACLE_SQL = {
    "matrix_pairs": f"""WITH cells AS ({_CELLS})
        SELECT c.sheet, c.case_name, c.row_no, c.case_name || '#row' || c.row_no AS pair_id, dtype, severity, g.text AS reference, c.text AS candidate
        FROM cells c JOIN ({corpus.LEGEND}) l ON c.row_no BETWEEN low AND high JOIN cells g ON g.sheet = c.sheet AND g.case_name = c.case_name AND g.row_no = 1
        WHERE EXISTS (SELECT 1 FROM cells s WHERE s.sheet = c.sheet AND s.case_name = c.case_name AND s.row_no = 0)""",
}
