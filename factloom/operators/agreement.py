"""Agreement of automatic and expert marks, and what was found of planted distortions."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .. import lexicons as lx
from ..sources.store import written


#: Ranges in which values are ranked; each is a task of its own.
RANGES = 32


def average_ranks(values: DataFrame, column: str) -> DataFrame:
    """values with column_rank: the average rank of ties; rows with a null are left out.

    Each distinct value's rows are counted first. The distinct values are cut
    into RANGES ranges at their quantiles, so no task sorts all of them, and
    what lies below a range is a sum over at most RANGES counts.
    """
    present = values.where(F.col(column).isNotNull())
    return present.join(_ranks(present, column), column)


def _ranks(values: DataFrame, column: str) -> DataFrame:
    """(column, column_rank) of each distinct value; their counts are written once and read for bounds, sums and ranks."""
    counts = written(values.groupBy(column).agg(F.count("*").alias("_n")))
    # approximate bounds are as good as exact ones: they only deal out the work
    bounds = sorted(set(counts.select(F.col(column).cast("double").alias("v")).approxQuantile("v", [k / RANGES for k in range(1, RANGES)], 0.01)))
    part = F.size(F.filter(F.lit(bounds), lambda b: b < F.col(column).cast("double"))) if bounds else F.lit(0)
    placed = counts.withColumn("_part", part)
    sizes, below = {r._part: r.n for r in placed.groupBy("_part").agg(F.sum("_n").alias("n")).collect()}, 0
    before = []
    for k in sorted(sizes):
        before.append((k, below))
        below += sizes[k]
    if not before:
        return counts.select(column, F.lit(None).cast("double").alias(f"{column}_rank"))
    offsets = values.sparkSession.createDataFrame(before, "_part int, _before long")
    upto = Window.partitionBy("_part").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    less = F.col("_before") + F.coalesce(F.sum("_n").over(upto), F.lit(0))
    return placed.join(F.broadcast(offsets), "_part").select(column, (less + (F.col("_n") + 1) / 2).alias(f"{column}_rank"))


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + step * d, 1 + step / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _fraction(b, a, 1 - x) / b


@F.arrow_udf(DoubleType())
def p_value(rho: pa.Array, n: pa.Array) -> pa.Array:
    """Two-sided: how likely a correlation this far from 0 is for n unrelated rows, by Student's t with n - 2 degrees; null where rho is."""

    def own(r: float | None, k: int) -> float | None:
        return None if r is None or k < 3 else incomplete_beta((k - 2) / 2, 0.5, max(0.0, 1 - r * r))

    return pa.array([own(r, k) for r, k in zip(rho.to_pylist(), n.to_pylist(), strict=True)], pa.float64())


def spearman(values: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, rho, p): the correlation of the average ranks and its p value; null below 3 rows or where a side is constant."""
    both = values.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    ranked = both.join(_ranks(both, x), x).join(_ranks(both, y), y)
    n, varied = F.count("*"), (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    rho = F.when((n >= 3) & varied, F.corr(f"{x}_rank", f"{y}_rank"))
    return ranked.agg(n.alias("n"), rho.alias("rho")).withColumn("p", p_value("rho", "n"))


def correlate(auto: DataFrame, expert: DataFrame, strict: bool = False) -> DataFrame:
    """One row: matched cases, Spearman's rho with p over severities, and the confusion of acceptable or not.

    auto: case_id, category, score; expert: the same with order, the row's place
    in its file. Of rows with the same case the last counts, on both sides. The
    automatic severity is the category's, else the score; the expert's is the
    score, else the category's. Cases without a partner are counted, not matched.
    """
    severity = F.create_map(*(F.lit(v) for k, name in enumerate((lx.READY, lx.EDIT, lx.REJECT)) for v in (name, float(k))))
    rank = lambda c: severity[F.trim(F.coalesce(c, F.lit("")))]
    a = last_by(auto.where("case_id IS NOT NULL"), "case_id", "order").select("case_id", F.col("category").alias("auto_category"), F.coalesce(rank(F.col("category")), F.col("score")).alias("auto_value"))
    e = last_by(expert.where("case_id IS NOT NULL"), "case_id", "order").select("case_id", F.col("category").alias("expert_category"), F.coalesce(F.col("score"), rank(F.col("category"))).alias("expert_value"))
    sides = a.select("case_id", F.lit(1).alias("side")).unionByName(e.select("case_id", F.lit(2).alias("side"))).groupBy("case_id").agg(F.sum("side").alias("sides"))
    matched = sides.agg(F.count_if(F.col("sides") == 3).alias("n_matched"), F.count_if(F.col("sides") == 1).alias("unmatched_auto"), F.count_if(F.col("sides") == 2).alias("unmatched_expert"))
    inner = a.join(e, "case_id")
    found = confusion(inner, acceptable(F.col("auto_category"), strict), acceptable(F.col("expert_category"), strict))
    return matched.crossJoin(spearman(inner, "auto_value", "expert_value").withColumnRenamed("n", "n_spearman")).crossJoin(found)


def acceptable(category: Column, strict: bool = False) -> Column:
    """Ready, and unless strict also to be edited; null for anything unknown."""
    name = F.trim(category)
    return F.when(name == lx.READY, True).when(name == lx.EDIT, not strict).when(name == lx.REJECT, False)


def confusion(rows: DataFrame, auto: Column, expert: Column) -> DataFrame:
    """One row: tp, fp, fn, tn (rejecting is the positive class), precision, recall, f1, accuracy; null on an empty denominator."""
    both = auto.isNotNull() & expert.isNotNull()
    count = lambda a, e: F.count_if(both & (auto == a) & (expert == e))
    out = rows.agg(count(False, False).alias("tp"), count(False, True).alias("fp"), count(True, False).alias("fn"), count(True, True).alias("tn"))
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return out.select("*", F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"), F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def last_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key: the last by order; of rows alike in it the greatest in all columns."""
    whole = F.max_by(F.struct(*rows.columns), F.struct(order, *(c for c in rows.columns if c not in (key, order))))
    return rows.groupBy(key).agg(whole.alias("_row")).select("_row.*")


def detection_rates(found: DataFrame, *by: str) -> DataFrame:
    """Rows, flagged rows and their share, by the given columns and over all (a rollup: nulls stand for all)."""
    return found.rollup(*by).agg(F.count("*").alias("n"), F.count_if("flagged").alias("n_flagged")).withColumn("rate", F.col("n_flagged") / F.col("n"))
