"""Queries on audit rows, drift, agreement with experts, and events in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..operators import agreement, drift, snapshots
from ..operators.compare import compare
from ..operators.gate import gate
from ..sources import tables
from ..streaming.audit import hourly_counts
from . import corpus
from . import facts as fact_plans

_SNAPSHOTS = f"""SELECT run_id, profile, n, n_reject, n_edit, n_ready, n_gate_reject, n_reject / n AS reject_rate, n_edit / n AS edit_rate, n_ready / n AS ready_rate, n_gate_reject / n AS gate_reject_rate FROM (
SELECT run_id, profile, count(*) AS n, count_if(category = '{lx.REJECT}') AS n_reject, count_if(category = '{lx.EDIT}') AS n_edit, count_if(category = '{lx.READY}') AS n_ready, count_if(gate_status = 'reject') AS n_gate_reject FROM ({corpus.AUDIT}) GROUP BY ALL)"""
_MOVES = f"""SELECT run_id, lag(n) OVER w IS NOT NULL AS has_old, r, o_r, g, o_g, abs(e - o_e) + abs(d - o_d) + abs(r - o_r) AS shift FROM (
SELECT *, lag(r) OVER w AS o_r, lag(g) OVER w AS o_g, lag(e) OVER w AS o_e, lag(d) OVER w AS o_d FROM (SELECT run_id, n, round(reject_rate, 4) AS r, round(gate_reject_rate, 4) AS g, round(edit_rate, 4) AS e, round(ready_rate, 4) AS d FROM ({_SNAPSHOTS})) WINDOW w AS (ORDER BY run_id)) WINDOW w AS (ORDER BY run_id)"""
#: An expert's mark on nine of ten records, by order; the automatic one is that of the audit.
_EXPERT = f"SELECT CAST(o_orderkey AS STRING) AS emr_id, CASE WHEN o_orderkey % 7 = 0 THEN 'неясно' WHEN o_totalprice < 60000 THEN '{lx.REJECT}' WHEN o_totalprice < 200000 THEN '{lx.EDIT}' ELSE '{lx.READY}' END AS expert_category FROM orders WHERE o_orderkey % 10 > 0"
_AUTO = f"SELECT * FROM ({corpus.AUDIT}) AS marks WHERE CAST(emr_id AS BIGINT) % 9 > 0"
_CONFUSION = "SELECT tp, fp, fn, tn, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy FROM (SELECT count_if(NOT a AND NOT e) AS tp, count_if(NOT a AND e) AS fp, count_if(a AND NOT e) AS fn, count_if(a AND e) AS tn FROM ({}))"


#: Monthly runs over lines, with a category that only the months of one half of the year have.
_SHIPPED = f"""SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS run_id, 'pilot' AS profile, CAST(l_orderkey AS STRING) AS emr_id, CAST(l_linenumber AS STRING) AS model_id,
CASE l_returnflag WHEN 'R' THEN '{lx.REJECT}' WHEN 'A' THEN '{lx.READY}' ELSE CASE WHEN month(l_shipdate) > 6 THEN '{lx.EDIT}' ELSE 'open' END END AS category, CASE l_linestatus WHEN 'F' THEN 'reject' ELSE 'pass' END AS gate_status, l_extendedprice AS price FROM lineitem"""
_SHARES = f"SELECT run_id, category, round(n / sum(n) OVER (PARTITION BY run_id), 4) AS rate FROM (SELECT run_id, category, count(*) AS n FROM ({_SHIPPED}) GROUP BY ALL)"
_RUNS = f"SELECT run_id, lag(run_id) OVER (ORDER BY run_id) AS baseline_id FROM (SELECT DISTINCT run_id FROM ({_SHIPPED}))"
_UNION = f"""SELECT run_id, baseline_id, category, coalesce(o.rate, 0) AS before, coalesce(n.rate, 0) AS after, coalesce(n.rate, 0) - coalesce(o.rate, 0) AS delta
FROM (SELECT r.run_id, r.baseline_id, s.category, s.rate FROM ({_RUNS}) r JOIN ({_SHARES}) s ON s.run_id = r.baseline_id) o
FULL JOIN (SELECT r.run_id, r.baseline_id, s.category, s.rate FROM ({_RUNS}) r JOIN ({_SHARES}) s ON s.run_id = r.run_id WHERE r.baseline_id IS NOT NULL) n USING (run_id, baseline_id, category)"""
_GATED = f"SELECT run_id, g - lag(g) OVER (ORDER BY run_id) AS delta FROM (SELECT run_id, round(count_if(gate_status = 'reject') / count(*), 4) AS g FROM ({_SHIPPED}) GROUP BY run_id)"


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_SHIPPED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=tables.read(spark, sf_dir, "lineitem"))
    return snapshots.snapshot(rows.withColumn("at", F.to_timestamp(F.concat("run_id", F.lit("01")), "yyyyMMdd")), F.col("price"))


def snapshot_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each category's share moved between months, those that only one of two months has included."""
    return snapshots.moves(_snapshots(spark, sf_dir)).withColumn("delta", F.round("delta", 4))


def snapshot_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.alerts(_snapshots(spark, sf_dir)).select("run_id", "metric", "severity", F.round("delta", 4).alias("delta"))


def merged_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from monthly snapshots: whether distinct orders and the median price are within four standard errors of the exact ones."""
    lines = tables.read(spark, sf_dir, "lineitem")
    exact = lines.groupBy(F.year("l_shipdate").cast("string").alias("year")).agg(F.countDistinct("l_orderkey").alias("n_orders"), *(F.percentile("l_extendedprice", q).alias(name) for name, q in (("low", 0.43), ("high", 0.57))))
    years = snapshots.merged(_snapshots(spark, sf_dir), F.substring("run_id", 1, 4).alias("year"))
    near = F.abs(F.col("n_records") - F.col("n_orders")) <= 0.065 * F.col("n_orders")
    return years.join(exact, "year").select("year", "n", "n_orders", near.alias("orders_close"), snapshots.quantile(F.col("measures"), 0.5).between(F.col("low"), F.col("high")).alias("median_close"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.frame(spark, sf_dir, corpus.AUDIT)


def audit_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.audit_rows(corpus.pairs(spark, sf_dir), F.lit("run")).drop("run_id")


def drift_snapshot_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.snapshots(_audit(spark, sf_dir))


def drift_snapshot_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.shares(_audit(spark, sf_dir), "category", "run_id", "model_id")


def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.alerts(drift.snapshots(_audit(spark, sf_dir))).select("run_id", "metric", "severity", F.round("delta", 4).alias("delta"))


def drift_objective_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate(compare(corpus.pairs(spark, sf_dir))).select(F.when(F.col("gate.status") != "reject", F.col("objective")).alias("objective"))
    return drift.objective_means(rows).select(*(F.round(c, 6).alias(c) for c in ("numeric_share", "polarity_share", "with_objective")))


def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read(spark, sf_dir, "orders")
    lines = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    both = orders.join(lines, "o_orderkey").select("o_totalprice", "n_lines")
    return agreement.spearman(both, "o_totalprice", "n_lines").select("n", F.round("rho", 6).alias("rho"))


def binary_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    auto, expert = corpus.frame(spark, sf_dir, _AUTO), corpus.frame(spark, sf_dir, _EXPERT)
    return agreement.confusion(auto.join(expert, "emr_id"), agreement.acceptable(F.col("category")), agreement.acceptable(F.col("expert_category")))


def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.confusion(tables.read(spark, sf_dir, "labels"), F.col("toxic") == 0, F.col("quality") == 1)


def correlate_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    auto, expert = corpus.frame(spark, sf_dir, _AUTO).select("emr_id"), corpus.frame(spark, sf_dir, _EXPERT).select("emr_id")
    return auto.join(expert, "emr_id", "left_anti").select(F.lit("auto").alias("side"), "emr_id").unionByName(expert.join(auto, "emr_id", "left_anti").select(F.lit("expert").alias("side"), "emr_id"))


def last_event_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a user: duplicates of a key give way to the last record."""
    return agreement.last_by(tables.read(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that a run of which a third is done has still to look at."""
    pairs = corpus.frame(spark, sf_dir, f"SELECT CAST(k AS STRING) AS emr_id, CAST(k % 6 AS STRING) AS model_id FROM ({corpus.KEYS}) AS keys")
    done = corpus.frame(spark, sf_dir, _AUTO).where("gate_status = 'pass'")
    return pairs.join(done.select("emr_id", "model_id"), ["emr_id", "model_id"], "left_anti")


def events_windowed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(tables.read(spark, sf_dir, "events"))


QUERIES = {
    f.__name__: f
    for f in (
        audit_hash, drift_snapshot_category, drift_snapshot_by_model, drift_alerts, drift_objective_means, spearman, binary_agreement,
        label_agreement, correlate_unmatched, last_event_by_user, resume_antijoin, events_windowed_drift,
        snapshot_moves, snapshot_alerts, merged_snapshots,
    )
}

ORACLE_SQL = {
    "audit_hash": f"SELECT emr_id, model_id, sha256(source_text) AS source_hash, sha256(summary_text) AS summary_hash FROM ({corpus.PAIRS})",
    "drift_snapshot_category": _SNAPSHOTS,
    "drift_snapshot_by_model": f"SELECT run_id, model_id, category, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY run_id, model_id) AS rate FROM ({corpus.AUDIT}) GROUP BY run_id, model_id, category",
    "drift_alerts": f"""SELECT run_id, metric, severity, round(delta, 4) AS delta FROM (
        SELECT run_id, 'reject_rate' AS metric, CASE WHEN r > o_r THEN 'alarm' ELSE 'notice' END AS severity, r - o_r AS delta FROM ({_MOVES}) WHERE has_old AND abs(r - o_r) >= 0.10 UNION ALL
        SELECT run_id, 'gate_reject_rate', CASE WHEN g > o_g THEN 'alarm' ELSE 'notice' END, g - o_g FROM ({_MOVES}) WHERE has_old AND abs(g - o_g) >= 0.10 UNION ALL
        SELECT run_id, 'category_shift', 'notice', shift FROM ({_MOVES}) WHERE has_old AND shift >= 0.15)""",
    "drift_objective_means": f"""SELECT round(avg(numeric_mismatches / n_a) FILTER (gate_status = 'pass') + avg(unit_mismatches / n_a) FILTER (gate_status = 'pass'), 6) AS numeric_share,
        round(avg(flips / 7) FILTER (gate_status = 'pass'), 6) AS polarity_share, round(avg(CAST(gate_status = 'pass' AS INT)), 6) AS with_objective FROM (SELECT *, 6 AS n_a FROM ({fact_plans._FOUND}))""",
    "spearman": """SELECT count(*) AS n, round(corr(a, b), 6) AS rho FROM (SELECT rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2 AS a, rank() OVER (ORDER BY n_lines) + (count(*) OVER (PARTITION BY n_lines) - 1) / 2 AS b
        FROM orders JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)""",
    "binary_agreement": _CONFUSION.format(f"SELECT CASE WHEN category IN ('{lx.READY}', '{lx.EDIT}') THEN true WHEN category = '{lx.REJECT}' THEN false END AS a, CASE WHEN expert_category IN ('{lx.READY}', '{lx.EDIT}') THEN true WHEN expert_category = '{lx.REJECT}' THEN false END AS e FROM ({_AUTO}) JOIN ({_EXPERT}) USING (emr_id)) WHERE (a IS NOT NULL AND e IS NOT NULL"),
    "label_agreement": _CONFUSION.format("SELECT toxic = 0 AS a, quality = 1 AS e FROM labels"),
    "correlate_unmatched": f"SELECT 'auto' AS side, emr_id FROM ({_AUTO}) ANTI JOIN ({_EXPERT}) USING (emr_id) UNION ALL SELECT 'expert', emr_id FROM ({_EXPERT}) ANTI JOIN ({_AUTO}) USING (emr_id)",
    "last_event_by_user": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
    "resume_antijoin": f"SELECT CAST(k AS STRING) AS emr_id, CAST(k % 6 AS STRING) AS model_id FROM ({corpus.KEYS}) WHERE CAST(k AS STRING) NOT IN (SELECT emr_id FROM ({_AUTO}) WHERE gate_status = 'pass')",
    "snapshot_moves": f"SELECT run_id, baseline_id, category, before, after, round(delta, 4) AS delta FROM ({_UNION})",
    "snapshot_alerts": f"""SELECT run_id, metric, severity, round(delta, 4) AS delta FROM (
        SELECT run_id, 'reject_rate' AS metric, CASE WHEN delta > 0 THEN 'alarm' ELSE 'notice' END AS severity, delta FROM ({_UNION}) WHERE category = '{lx.REJECT}' AND abs(delta) >= 0.10 UNION ALL
        SELECT run_id, 'gate_reject_rate', CASE WHEN delta > 0 THEN 'alarm' ELSE 'notice' END, delta FROM ({_GATED}) WHERE abs(delta) >= 0.10 UNION ALL
        SELECT run_id, 'category_shift', 'notice', sum(abs(delta)) FROM ({_UNION}) GROUP BY run_id HAVING sum(abs(delta)) >= 0.15)""",
    "merged_snapshots": "SELECT CAST(year(l_shipdate) AS STRING) AS year, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders, true AS orders_close, true AS median_close FROM lineitem GROUP BY 1",
    "events_windowed_drift": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
}
