"""Readers and writers: tables, text folders, sheets as CSV, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import charsets

PAIRS = "emr_id string, model_id string, source_text string, summary_text string"
MODELS = {"1": "2", "2": "11", "3": "23", "4": "89", "5": "38", "6": "19"}  # fixed values: model ids by file number


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs from files textN_source.txt and textN_modelM.txt in any known encoding; M names the model by MODELS, numbers without an entry stand for themselves."""
    files = charsets.text_files(spark, f"{folder}/*.txt")
    number = F.regexp_extract("name", r"^text(\d+)_", 1)
    model = F.regexp_extract("name", r"_model(\d+)\.txt$", 1)
    named = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in MODELS.items() for x in kv)), "model"), F.col("model"))
    sources = files.where(F.col("name").endswith("_source.txt")).select(number.alias("emr_id"), F.col("text").alias("source_text"))
    summaries = files.select(number.alias("emr_id"), model.alias("model"), F.col("text").alias("summary_text")).where("model <> ''")
    return sources.join(summaries, "emr_id").select("emr_id", named.alias("model_id"), "source_text", "summary_text")


def csv_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs from CSV with a header; all columns are strings and nulls become empty."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').select(*(F.coalesce(F.col(c.split()[0]).cast("string"), F.lit("")).alias(c.split()[0]) for c in PAIRS.split(", ")))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Rows added to a folder of JSON lines, the audit log's form."""
    rows.write.mode("append").json(path)
