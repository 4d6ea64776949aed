"""Audit rows, snapshots of runs, and alerts on what moved between two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as lx


def audit_rows(pairs: DataFrame, run_id: Column) -> DataFrame:
    """(run_id, emr_id, model_id, source_hash, summary_hash): hashes stand for the texts, which an audit never holds; a null text has none."""
    digest = lambda c: F.sha2(F.col(c), 256)
    return pairs.select(run_id.alias("run_id"), "emr_id", "model_id", digest("source_text").alias("source_hash"), digest("summary_text").alias("summary_hash"))


def shares(audit: DataFrame, column: str, *by: str) -> DataFrame:
    """(by, column, n, rate): the rows of each value and their share within by. Values are counted first, so the second step is small."""
    counts = audit.groupBy(*by, column).agg(F.count("*").alias("n"))
    total = counts.groupBy(*by).agg(F.sum("n").alias("of"))
    return counts.join(total, list(by)).select(*by, column, "n", (F.col("n") / F.col("of")).alias("rate"))


def snapshots(audit: DataFrame) -> DataFrame:
    """One row a run: n, how many and what share was rejected, to be edited, ready, or rejected by the gate.

    audit: run_id, profile, category, gate_status. Runs are few; the counts are
    partial sums before the shuffle.
    """
    has = lambda c, v: F.count_if(F.col(c) == v)
    out = audit.groupBy("run_id", "profile").agg(F.count("*").alias("n"), has("category", lx.REJECT).alias("n_reject"), has("category", lx.EDIT).alias("n_edit"), has("category", lx.READY).alias("n_ready"), has("gate_status", "reject").alias("n_gate_reject"))
    return out.select("*", *((F.col(f"n_{c}") / F.col("n")).alias(f"{c}_rate") for c in ("reject", "edit", "ready", "gate_reject")))


def alerts(snapshots: DataFrame) -> DataFrame:
    """(run_id, metric, baseline, current, delta, threshold, severity) of each run against the one before it.

    Rates are rounded to four places first. A change of profile gives that
    alert alone. Growth is "alarm", anything else "notice".
    """
    rates = ("reject_rate", "gate_reject_rate", "edit_rate", "ready_rate")
    order = Window.partitionBy(F.lit(0)).orderBy("run_id")  # one row a run: the number of runs, not of pairs
    now = snapshots.select("run_id", "profile", *(F.round(c, 4).alias(c) for c in rates))
    both = now.select("*", F.lag("profile").over(order).alias("old_profile"), *(F.lag(c).over(order).alias(f"old_{c}") for c in rates)).where("old_profile IS NOT NULL")
    move = lambda c: F.col(c) - F.col(f"old_{c}")
    return fired(both, sum((F.abs(move(c)) for c in ("edit_rate", "ready_rate")), F.abs(move("reject_rate"))))


def fired(both: DataFrame, total: Column) -> DataFrame:
    """The alerts of rows with run_id, profile, reject_rate and gate_reject_rate, and old_ of each; total is how far all categories moved."""
    move = lambda c: F.col(c) - F.col(f"old_{c}")

    def alert(metric: str, baseline: Column, current: Column, delta: Column, limit: float, severity: Column, fires: Column) -> Column:
        return F.when(fires, F.struct(F.lit(metric).alias("metric"), baseline.alias("baseline"), current.alias("current"), delta.alias("delta"), F.lit(limit).alias("threshold"), severity.alias("severity")))

    # an unknown profile is comparable with any
    zero, same = F.lit(0.0), F.coalesce(F.col("profile") == F.col("old_profile"), F.lit(True))
    found = [alert("profile", zero, zero, zero, 0.0, F.lit("notice"), ~same)]
    for c in ("reject_rate", "gate_reject_rate"):
        found.append(alert(c, F.col(f"old_{c}"), F.col(c), move(c), lx.DRIFT_LIMITS[c], F.when(move(c) > 0, "alarm").otherwise("notice"), same & (F.abs(move(c)) >= lx.DRIFT_LIMITS[c])))
    found.append(alert("category_shift", zero, total, total, lx.DRIFT_LIMITS["category_shift"], F.lit("notice"), same & (total >= lx.DRIFT_LIMITS["category_shift"])))
    return both.select("run_id", F.explode(F.array_compact(F.array(*found))).alias("a")).select("run_id", "a.*")


def objective_means(rows: DataFrame) -> DataFrame:
    """One row: means of the findings' shares over the rows that have a total, and the share of rows with an objective part."""
    share = lambda part, count: F.try_divide(F.col(f"objective.{part}.{count}"), F.col(f"objective.{part}.total_in_a"))
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return rows.agg(
        (mean(share("numeric", "mismatch_count")) + mean(share("numeric", "unit_mismatch_count"))).alias("numeric_share"),
        mean(share("polarity", "flip_count")).alias("polarity_share"),
        F.avg(F.col("objective").isNotNull().cast("double")).alias("with_objective"),
    )
