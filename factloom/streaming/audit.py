"""Counts over time, the same for a table and for a stream of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators import snapshots
from ..sources.store import Store


def hourly_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """(hour, event_type, n). On a stream, rows later than late are dropped; a table keeps all."""
    if events.isStreaming:
        # a watermark needs a time with a zone; times without one are read in the session's
        events = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")


def follow(spark: SparkSession, path: str, schema: str, late: str = "1 day") -> DataFrame:
    """The audit rows of a growing folder of JSON lines, each (run_id, emr_id, model_id) once within the watermark."""
    rows = spark.readStream.schema(schema).json(path).withWatermark("ts", late)
    return rows.dropDuplicatesWithinWatermark(["run_id", "emr_id", "model_id"])


def counted(rows: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """A writer of daily category counts to an in-memory or catalog table, for everything that is there now."""
    counts = rows.groupBy(F.window("ts", "1 day").alias("w"), "category").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "category", "n")
    return counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).queryName(table).format("memory").trigger(availableNow=True)


def cell_store(spark: SparkSession, path: str) -> Store:
    """The counted parts of a followed audit: one row a cell of snapshots and micro-batch."""
    return Store(spark, path, StructType.fromDDL(f"{snapshots.CELLS}, batch bigint"), ["run_id", "model_id", "category", "gate_status", "batch"])


def count_batch(kept: Store, batch: DataFrame, number: int) -> None:
    """Adds the cells of one micro-batch. Done again for the same number, as after a lost driver, it replaces its own rows."""
    kept.add(snapshots.cells(batch).withColumn("batch", F.lit(number).cast("long")), number)


def snapshots_of(rows: DataFrame, kept: Store, checkpoint: str) -> DataStreamWriter:
    """A writer that counts everything that is there now into kept; one checkpoint a store, as batches are told by number."""
    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, number: count_batch(kept, batch, number))


def current(kept: Store) -> DataFrame:
    """The snapshots of all that has been followed so far, for snapshots.moves and snapshots.alerts."""
    return snapshots.of_cells(kept.newest())
