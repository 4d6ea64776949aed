"""Tables of results that runs add to: batches of rows by key, the newest of each key counts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; only a local session without one gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='factloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """rows written below the shared folder and read again, so that what is read several times is computed once."""
    path = shared_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Store:
    """A folder of Parquet batches with a version; rows of later versions replace earlier ones of their key.

    A batch is written as a whole or not at all (Spark commits its files at the
    end), so that what a killed run leaves is whole batches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = StructType([*schema.fields, StructField("version", LongType())])

    def rows(self) -> DataFrame:
        """All rows of all versions; none where nothing has been written yet."""
        try:
            # batches of earlier formats lack columns, which are null then
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def newest(self) -> DataFrame:
        """One row of each key: that of the greatest version."""
        order = Window.partitionBy(*self.keys).orderBy(F.desc("version"))
        return self.rows().withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")

    def add(self, batch: DataFrame, version: int) -> None:
        batch.withColumn("version", F.lit(version).cast("long")).select(self.schema.names).write.mode("append").parquet(self.path)

    def next_version(self) -> int:
        return (self.rows().agg(F.max("version")).first()[0] or 0) + 1
