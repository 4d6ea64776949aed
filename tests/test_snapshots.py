"""Snapshots kept, compared over all categories, and merged."""

import pytest
from pyspark.sql import functions as F

from factloom import lexicons as lx
from factloom.operators import snapshots

AUDIT = "run_id string, profile string, at string, emr_id string, model_id string, category string, gate_status string, score double"


def rows(run, at, categories, profile="pilot"):
    return [(run, profile, at, f"{k % 7}", f"m{k % 2}", c, "reject" if k == 0 else "pass", float(k)) for k, c in enumerate(categories)]


@pytest.fixture
def two(spark):
    return spark.createDataFrame(rows("z", "2024-01-01", [lx.READY] * 6 + ["old"] * 4) + rows("a", "2024-02-01", [lx.READY] * 6 + ["new"] * 4), AUDIT)


def test_counts_shares_and_models(two):
    got = {r.run_id: r for r in snapshots.snapshot(two, F.col("score")).collect()}
    z = got["z"]
    assert (z.n, z.profile, z.categories, z.category_rates, z.gates, z.gate_rates) == (10, "pilot", {lx.READY: 6, "old": 4}, {lx.READY: 0.6, "old": 0.4}, {"reject": 1, "pass": 9}, {"reject": 0.1, "pass": 0.9})
    assert z.by_model == {"m0": {lx.READY: 0.6, "old": 0.4}, "m1": {lx.READY: 0.6, "old": 0.4}}


def test_categories_of_one_run_only_move_and_fire(two):
    taken = snapshots.snapshot(two)
    # the order is that of time, not of names
    assert {(r.run_id, r.baseline_id, r.category, r.before, r.after) for r in snapshots.moves(taken).collect()} == {("a", "z", lx.READY, 0.6, 0.6), ("a", "z", "old", 0.4, 0.0), ("a", "z", "new", 0.0, 0.4)}
    assert [(r.run_id, r.metric, round(r.delta, 9)) for r in snapshots.alerts(taken).collect()] == [("a", "category_shift", 0.8)]


def test_other_profile_gives_that_alert_alone(spark):
    frame = spark.createDataFrame(rows("a", "2024-01-01", ["x"] * 4) + rows("b", "2024-02-01", ["y"] * 4, "full") + rows("c", "2024-03-01", ["z"] * 4, None), AUDIT)
    assert [(r.run_id, r.metric) for r in snapshots.alerts(snapshots.snapshot(frame)).orderBy("run_id", "metric").collect()] == [("b", "profile"), ("c", "category_shift")]


def test_kept_again_replaces(spark, two, tmp_path):
    kept = snapshots.store(spark, str(tmp_path / "kept"))
    assert kept.newest().count() == 0
    snapshots.keep(kept, snapshots.snapshot(two, F.col("score")))
    snapshots.keep(kept, snapshots.snapshot(spark.createDataFrame(rows("a", "2024-02-01", [lx.READY] * 3), AUDIT), F.col("score")))
    got = {r.run_id: (r.n, r.version) for r in snapshots.store(spark, str(tmp_path / "kept")).newest().collect()}
    assert got == {"z": (10, 1), "a": (3, 2)}
    assert snapshots.moves(kept.newest()).where("category = 'new'").count() == 0


def test_merged_is_that_of_all_rows(spark):
    frame = spark.range(60_000).select((F.col("id") % 12).cast("string").alias("run_id"), F.lit("p").alias("profile"), F.lit(None).alias("at"), (F.col("id") % 20_000).cast("string").alias("emr_id"), F.lit("m").alias("model_id"), F.lit("c").alias("category"), F.lit("pass").alias("gate_status"), F.col("id").cast("double").alias("score"))
    row = snapshots.merged(snapshots.snapshot(frame, F.col("score")), F.lit(1).alias("all")).withColumn("median", snapshots.quantile(F.col("measures"), 0.5)).first()
    assert row.n == 60_000 and abs(row.n_records - 20_000) < 0.065 * 20_000 and abs(row.median - 30_000) < 0.07 * 60_000


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None,) * 8, (None,) * 8, ("r", None, None, "1", None, "c", None, None)], AUDIT)
    got = {r.run_id: r for r in snapshots.snapshot(frame, F.col("score")).withColumn("median", snapshots.quantile(F.col("measures"), 0.5)).collect()}
    assert got["—"].categories == {"—": 2} and got["r"].gates == {"—": 1} and got["r"].median is None
    none = snapshots.snapshot(frame.limit(0))
    assert none.count() == 0 and snapshots.alerts(none).count() == 0 and snapshots.moves(none).count() == 0
