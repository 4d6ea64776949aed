"""Snapshots of runs as rows that are kept, compared over the union of their categories, and merged by their sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import lexicons as lx
from ..sources.store import Store
from .drift import fired

#: HyperLogLog registers (2 ** 12: a standard error of 1.6 %), and the size of a quantile sketch (200: a rank error of 1.7 %).
REGISTERS, QUANTILES = 12, 200
UNKNOWN = "—"
CELLS = "run_id string, model_id string, category string, gate_status string, n bigint, profile string, at timestamp, records binary, measures binary"
SCHEMA = "run_id string, profile string, at timestamp, n bigint, categories map<string,bigint>, category_rates map<string,double>, gates map<string,bigint>, gate_rates map<string,double>, by_model map<string,map<string,double>>, records binary, measures binary"


def _rates(counts: Column) -> Column:
    total = F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.transform_values(counts, lambda _, n: F.round(n / total, 4))


def snapshot(audit: DataFrame, measure: Column | None = None) -> DataFrame:
    """One row a run, see SCHEMA: counts and shares of categories and gate statuses, shares by model, and two sketches.

    audit: run_id, profile, at, emr_id, model_id, category, gate_status. records
    is a sketch of the distinct emr_ids, measures one of the values of measure.
    Rows are first counted by run, model, category and status, with a partial
    count before that shuffle; only these cells, which are as few as the
    taxonomy's names allow, are turned about. Null names count as UNKNOWN, a
    run's profile is the least and its time the latest of its rows; null
    measures and emr_ids are in no sketch. An empty table gives no rows.
    """
    return of_cells(cells(audit, measure))


def cells(audit: DataFrame, measure: Column | None = None) -> DataFrame:
    """The rows of an audit counted by run, model, category and status, see CELLS."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
    rows = audit.select(name("run_id").alias("run_id"), "profile", F.col("at").cast("timestamp").alias("at"), F.col("emr_id").cast("string").alias("emr_id"), *(name(c).alias(c) for c in ("model_id", "category", "gate_status")), (F.lit(None) if measure is None else measure).cast("double").alias("measure"))
    return rows.groupBy("run_id", "model_id", "category", "gate_status").agg(
        F.count("*").alias("n"), F.min("profile").alias("profile"), F.max("at").alias("at"), F.hll_sketch_agg("emr_id", REGISTERS).alias("records"), F.kll_sketch_agg_double("measure", QUANTILES).alias("measures")
    )


def of_cells(cells: DataFrame) -> DataFrame:
    """The snapshots of cells; several of one run, model, category and status, from parts of a run, add up."""
    # every cell speaks of its category, its status and its model; the sketches go with the first only
    about = lambda kind, model, value, whole: F.struct(F.lit(kind).alias("kind"), model.alias("model"), F.col(value).alias("value"), *((F.col(c) if whole else F.lit(None)).cast("binary").alias(c) for c in ("records", "measures")))
    alone = F.lit(None).cast("string")
    told = cells.select("run_id", "n", "profile", "at", F.explode(F.array(about("category", alone, "category", True), about("gate", alone, "gate_status", False), about("model", F.col("model_id"), "category", False))).alias("c")).select("run_id", "n", "profile", "at", "c.*")
    both = lambda: (F.min("profile").alias("profile"), F.max("at").alias("at"), F.hll_union_agg("records").alias("records"), F.kll_merge_agg_double("measures", QUANTILES).alias("measures"))
    values = told.groupBy("run_id", "kind", "model", "value").agg(F.sum("n").alias("n"), *both())
    kinds = values.groupBy("run_id", "kind", "model").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias("counts"), F.sum("n").alias("n"), *both())
    of = lambda kind, c: F.first(F.when(F.col("kind") == kind, F.col(c)), ignorenulls=True)
    runs = kinds.groupBy("run_id").agg(
        F.min("profile").alias("profile"), F.max("at").alias("at"), of("category", "n").alias("n"), of("category", "counts").alias("categories"), of("gate", "counts").alias("gates"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "model", F.struct("model", _rates(F.col("counts")).alias("rates"))))).alias("by_model"),
        of("category", "records").alias("records"), of("category", "measures").alias("measures"),
    )
    return runs.withColumns({"category_rates": _rates(F.col("categories")), "gate_rates": _rates(F.col("gates"))}).select(*(c.split()[0] for c in SCHEMA.split(", ")))


def store(spark: SparkSession, path: str) -> Store:
    """The kept snapshots of a folder; a run that is kept again replaces its earlier snapshot."""
    return Store(spark, path, StructType.fromDDL(SCHEMA), ["run_id"])


def keep(kept: Store, snapshots: DataFrame) -> None:
    """Adds the snapshots as one version."""
    kept.add(snapshots, kept.next_version())


def _beside(snapshots: DataFrame) -> DataFrame:
    """Each run beside the one before it, by time and then by name: one row a run, so the number of runs and not of pairs."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("at").asc_nulls_first(), "run_id")
    named = snapshots.select("run_id", "at", "profile", "category_rates", "gate_rates")
    return named.select("*", F.lag("run_id").over(order).alias("baseline_id"), *(F.lag(c).over(order).alias(f"old_{c}") for c in ("profile", "category_rates", "gate_rates"))).where("baseline_id IS NOT NULL")


def _union(old: Column, new: Column) -> Column:
    """Each category of either run with its shares before and after; 0 where a run lacks it."""
    return F.map_zip_with(old, new, lambda _, a, b: F.struct(F.coalesce(a, F.lit(0.0)).alias("before"), F.coalesce(b, F.lit(0.0)).alias("after")))


def moves(snapshots: DataFrame) -> DataFrame:
    """(run_id, baseline_id, category, before, after, delta) for all categories that a run or the one before it has."""
    out = _beside(snapshots).select("run_id", "baseline_id", F.explode(_union(F.col("old_category_rates"), F.col("category_rates"))).alias("category", "share"))
    return out.select("run_id", "baseline_id", "category", "share.before", "share.after", (F.col("share.after") - F.col("share.before")).alias("delta"))


def alerts(snapshots: DataFrame) -> DataFrame:
    """The alerts of drift.alerts from snapshots: categories that only one of two runs has move the distribution too."""
    share = lambda c, key: F.coalesce(F.try_element_at(F.col(c), F.lit(key)), F.lit(0.0))
    both = _beside(snapshots).withColumns({"reject_rate": share("category_rates", lx.REJECT), "old_reject_rate": share("old_category_rates", lx.REJECT), "gate_reject_rate": share("gate_rates", "reject"), "old_gate_reject_rate": share("old_gate_rates", "reject")})
    total = F.aggregate(F.map_values(_union(F.col("old_category_rates"), F.col("category_rates"))), F.lit(0.0), lambda a, s: a + F.abs(s["after"] - s["before"]))
    return fired(both, total)


def merged(snapshots: DataFrame, by: Column) -> DataFrame:
    """Snapshots put together: n, the distinct records and the sketch of measures of several runs, without a look at their rows."""
    out = snapshots.groupBy(by).agg(F.sum("n").alias("n"), F.hll_union_agg("records").alias("records"), F.kll_merge_agg_double("measures", QUANTILES).alias("measures"))
    return out.withColumn("n_records", F.hll_sketch_estimate("records"))


def quantile(measures: Column, share: float) -> Column:
    """The value at a share of a sketch of measures; null where it has none."""
    return F.when(F.kll_sketch_get_n_double(measures) > 0, F.kll_sketch_get_quantile_double(measures, F.lit(share)))
