"""A followed folder of audit rows gives the snapshots and alerts of the whole table, over a restart and a repeated batch."""

import datetime
import json

from pyspark.sql import functions as F

from factloom import lexicons as lx
from factloom.operators import snapshots
from factloom.streaming import audit

SCHEMA = "run_id string, profile string, ts timestamp, emr_id string, model_id string, category string, gate_status string"


def rows(run, day, n, reject):
    return [{"run_id": run, "profile": "pilot", "ts": f"2024-01-{day:02}T10:00:00Z", "emr_id": f"{k}", "model_id": f"m{k % 3}", "category": lx.REJECT if k < reject else lx.READY, "gate_status": "pass"} for k in range(n)]


def put(folder, name, own):
    (folder / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in own), encoding="utf-8")


def plain(frame):
    return sorted(map(str, frame.drop("records", "measures").collect()))


def test_follow_restart_and_repeat(spark, tmp_path):
    folder, kept, checkpoint = tmp_path / "log", audit.cell_store(spark, str(tmp_path / "cells")), str(tmp_path / "checkpoint")
    folder.mkdir()

    def go():
        followed = audit.follow(spark, str(folder), SCHEMA).withColumn("at", F.col("ts"))
        audit.snapshots_of(followed, kept, checkpoint).start().awaitTermination()

    put(folder, "a.json", rows("r1", 1, 30, 3) + rows("r2", 2, 10, 5))
    go()
    # the run goes on after a stop; what was there already comes again
    put(folder, "b.json", rows("r2", 2, 30, 15) + rows("r1", 1, 30, 3)[:4])
    go()
    whole = snapshots.snapshot(spark.createDataFrame([{**r, "ts": datetime.datetime.fromisoformat(r["ts"])} for r in rows("r1", 1, 30, 3) + rows("r2", 2, 10, 5) + rows("r2", 2, 30, 15)[10:]], SCHEMA).withColumn("at", F.col("ts")))
    got = audit.current(kept)
    assert plain(got) == plain(whole) and plain(snapshots.alerts(got)) == plain(snapshots.alerts(whole)) and snapshots.alerts(got).count() == 2
    before = plain(got)
    again = kept.rows().agg(F.max("batch")).first()[0]
    # a batch that is done again after a failure counts once
    audit.count_batch(kept, spark.createDataFrame([("r9", "pilot", None, "1", "m", "c", "pass", None)], SCHEMA + ", at timestamp"), again + 1)
    audit.count_batch(kept, spark.createDataFrame([("r9", "pilot", None, "1", "m", "c", "pass", None)], SCHEMA + ", at timestamp"), again + 1)
    assert [r.n for r in audit.current(kept).where("run_id = 'r9'").collect()] == [1] and plain(audit.current(kept).where("run_id <> 'r9'")) == before


def test_hourly_counts_of_a_stream_are_those_of_the_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    audit.hourly_counts(stream, "3650 days").writeStream.outputMode("complete").format("memory").queryName("hourly").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    told = lambda frame: sorted(map(tuple, frame.withColumn("hour", F.col("hour").cast("string")).collect()))
    assert told(spark.table("hourly")) == told(audit.hourly_counts(events))
