"""Runs that are stopped, started again, limited, scoped, and that meet failing pairs."""

import pytest
from pyspark.sql import functions as F

from factloom import lexicons as lx
from factloom.operators import runs
from factloom.plans import corpus
from factloom.sources import store

SF_DIR = "/root/testdata/sf0.001"
VOTES = "emr_id string, model_id string, round int, role string, block string, code string, pass boolean"


@pytest.fixture(scope="module")
def pairs(spark):
    return corpus.pairs(spark, SF_DIR).where("CAST(emr_id AS BIGINT) BETWEEN 21 AND 40").select("emr_id", "model_id", "source_text", "summary_text").cache()


@pytest.fixture(scope="module")
def votes_of(spark, pairs):
    rows = [(b, f"{b}{k}", r) for b, n in lx.BLOCKS.items() for k in range(1, n + 1) for r in ("x", "y")]
    codes = spark.createDataFrame(rows, "block string, code string, role string")
    return pairs.select("emr_id", "model_id").crossJoin(codes).select("emr_id", "model_id", F.lit(1).alias("round"), "role", "block", "code", F.lit(True).alias("pass")).cache()


def rows_of(run):
    return sorted((r.emr_id, r.model_id, r.gate_status, r.category, str(r.objective), r.error) for r in run.results.collect())


def quick(batch):
    """An evaluation that costs nothing, for what doesn't depend on the findings."""
    gate = F.when(F.col("emr_id").cast("long") % 3 == 0, "reject").otherwise("pass")
    found = F.when(gate == "pass", F.from_json(F.lit('{"flips": 1}'), runs.EVALUATION["objective"].dataType))
    return batch.select(*runs.KEYS, gate.alias("gate_status"), F.array().cast("array<string>").alias("reasons"), found.alias("objective"), F.lit(None).cast("string").alias("error"))


def counted(seen):
    def work(batch):
        seen.append(batch.count())
        return quick(batch)

    return work


def test_a_stopped_run_goes_on(spark, pairs, votes_of):
    whole = rows_of(runs.run(pairs, store.shared_path(spark, "t"), votes_of, work=quick, batches=1))
    path, calls = store.shared_path(spark, "t"), []

    def killed(batch):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(batch.count())
        return quick(batch)

    with pytest.raises(KeyboardInterrupt):
        runs.run(pairs, path, votes_of, work=killed, batches=4)
    seen = []
    again = runs.run(pairs, path, votes_of, work=counted(seen), batches=4)
    assert rows_of(again) == whole and len(whole) == pairs.count()
    assert 0 < sum(calls) and sum(calls) + sum(seen) == len(whole)
    third = []
    assert rows_of(runs.run(pairs, path, votes_of, work=counted(third))) == whole and sum(third) == 0
    assert {r.category for r in again.results.collect()} == {lx.READY, lx.REJECT}
    snapshot = again.snapshot.collect()
    assert [(s.run_id, s.n) for s in snapshot] == [("run", len(whole))]
    assert set(again.audit.columns) >= {"source_hash", "category", "gate_status", "objective", "profile"} and "source_text" not in again.audit.columns


def test_limit_and_scope(spark, pairs, votes_of):
    path = store.shared_path(spark, "t")
    first = runs.run(pairs, path, votes_of, limit=3, work=quick, batches=1)
    assert [r.emr_id for r in first.results.orderBy("emr_id").collect()] == sorted(r.emr_id for r in pairs.collect())[:3]
    seen = []
    runs.run(pairs, path, votes_of, scope="radiologist", work=counted(seen), batches=1)
    assert seen == [pairs.count()]  # another scope is another evaluation
    again = []
    assert rows_of(runs.run(pairs, path, votes_of, limit=3, work=counted(again), batches=1)) == rows_of(first) and again == [0]


def test_the_evaluation_itself(spark, pairs):
    known = {r.emr_id: r for r in runs.evaluate(pairs.withColumn("scope", F.lit(None).cast("string"))).collect()}
    scoped = runs.evaluate(pairs.withColumn("scope", F.lit("radiologist"))).collect()
    assert {r.gate_status for r in scoped} == {"pass"} and {r.gate_status for r in known.values()} == {"pass", "reject"}
    assert all((r.objective is None) == (r.gate_status == "reject") for r in known.values())


def test_a_failing_pair_is_a_row(spark, pairs, votes_of):
    bad = sorted(r.emr_id for r in pairs.collect())[4]
    fails = F.udf(lambda e: 1 // (e != bad), "int")
    path = store.shared_path(spark, "t")
    broken = runs.run(pairs, path, votes_of, work=lambda b: quick(b.where(fails("emr_id") == 1)), batches=1)
    found = {r.emr_id: r for r in broken.results.collect()}
    assert len(found) == pairs.count() and "ZeroDivisionError" in found[bad].error and found[bad].category == lx.REJECT
    assert [e for e, r in found.items() if r.error] == [bad] and found[bad].verdict.startswith("error")
    seen = []
    mended = runs.run(pairs, path, votes_of, work=counted(seen), batches=1)
    assert seen == [1] and not [r for r in mended.results.collect() if r.error]


def test_rows_of_an_older_form_are_done_again(spark, pairs, votes_of):
    path = store.shared_path(spark, "t")
    pairs.select("emr_id", "model_id", F.lit(None).cast("string").alias("scope"), F.lit("pass").alias("gate_status"), F.lit(1).cast("long").alias("version")).write.parquet(path)
    seen = []
    runs.run(pairs, path, votes_of, work=counted(seen), batches=1)
    assert seen == [pairs.count()]


def test_no_pairs(spark, pairs, votes_of):
    done = runs.run(pairs.limit(0), store.shared_path(spark, "t"), votes_of, work=quick, batches=1)
    assert done.results.count() == 0 and done.snapshot.count() == 0


def test_other_errors_stop_the_run(spark, pairs, votes_of):
    with pytest.raises(ValueError):
        runs.run(pairs, store.shared_path(spark, "t"), votes_of, work=lambda b: (_ for _ in ()).throw(ValueError("no")))


def test_repeated_pairs_and_null_ids(spark, pairs, votes_of):
    """F8: repeated pairs are evaluated once, by their least texts, and pairs without an id keep their row, also when the run goes on."""
    odd = pairs.unionByName(pairs.withColumn("summary_text", F.lit("я"))).unionByName(pairs.limit(1).withColumn("emr_id", F.lit(None).cast("string")))
    path, seen, texts = store.shared_path(spark, "t"), [], []

    def work(batch):
        texts.extend(r.summary_text for r in batch.collect())
        return counted(seen)(batch)

    done = runs.run(odd, path, votes_of, work=work, batches=3)
    ids = [r.emr_id for r in done.results.collect()]
    assert len(ids) == sum(seen) == pairs.count() + 1 and ids.count(None) == 1 and "я" not in texts
    again = []
    assert runs.run(odd, path, votes_of, work=counted(again), batches=2).results.count() == len(ids) and sum(again) == 0


def test_texts_are_shuffled_once(spark, pairs, votes_of):
    """F8: one shuffle brings the texts of repeated pairs together and leaves out what is done; no join sees a text."""
    plans = []

    def work(batch):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return quick(batch)

    runs.run(pairs, store.shared_path(spark, "t"), votes_of, work=work, batches=2)
    assert len(plans) == 2 and all("Join" not in p and p.count("RepartitionByExpression") == 1 for p in plans)
