"""Places of candidates by their decision and their passed criteria."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as lx


def ranked(decided: DataFrame, within: str) -> DataFrame:
    """(within, emr_id, model_id, rank, real_errors, passed, place).

    The better category first, then no stop signal, then fewer real errors (what
    a summary says wrongly, not what it leaves out), then more passed criteria,
    then the lesser emr_id. Places count within a case, whose candidates are few.
    """
    rank = F.when(F.col("category") == lx.READY, 3).when(F.col("category") == lx.EDIT, 2).when(F.col("category") == lx.REJECT, 1).otherwise(0)
    rows = decided.select(within, "emr_id", "model_id", rank.alias("rank"), F.coalesce("e1_triggered", F.lit(False)).alias("e1"), F.coalesce("real_errors", F.lit(0)).alias("real_errors"), F.coalesce("passed", F.lit(0)).alias("passed"))
    order = Window.partitionBy(within).orderBy(F.desc("rank"), "e1", "real_errors", F.desc("passed"), F.expr("try_cast(emr_id AS bigint)"), "emr_id")
    return rows.withColumn("place", F.row_number().over(order)).drop("e1")
