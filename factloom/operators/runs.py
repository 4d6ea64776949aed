"""A run over a corpus of pairs that can be stopped and started again, and in which a failing pair is a row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .. import lexicons as lx
from ..sources.store import Store
from . import drift, votes
from .compare import counted
from .gate import gate

KEYS = ("emr_id", "model_id", "scope")
_FINDINGS = StructType([StructField(c, IntegerType()) for c in ("numeric_mismatches", "unit_mismatches", "flips", "causal", "claims")])
EVALUATION = StructType([*(StructField(c, StringType()) for c in (*KEYS, "gate_status")), StructField("reasons", ArrayType(StringType())), StructField("objective", _FINDINGS), StructField("error", StringType())])

Evaluate = Callable[[DataFrame], DataFrame]


def evaluate(pairs: DataFrame) -> DataFrame:
    """The gate and the objective findings of pairs with their scope; those that the gate rejects have no findings."""
    done = gate(counted(pairs, for_gate=True), F.col("scope"))
    found = F.struct(*(F.col(f"counts.{c}").cast("int").alias(c) for c in _FINDINGS.names))
    return done.select(*KEYS, F.col("gate.status").alias("gate_status"), F.transform("gate.reasons", lambda r: r["code"]).alias("reasons"), F.when(F.col("gate.status") != "reject", found).alias("objective"), F.lit(None).cast("string").alias("error"))


@dataclass
class Run:
    """What a run gives: a row for each pair, its audit rows, and their snapshot."""

    results: DataFrame
    audit: DataFrame
    snapshot: DataFrame


def store(spark: SparkSession, path: str) -> Store:
    return Store(spark, path, EVALUATION, KEYS)


def _usable(newest: DataFrame) -> DataFrame:
    """Keys whose newest row is an evaluation in today's form: errors and rows of older forms are done again."""
    return newest.where("error IS NULL AND gate_status IS NOT NULL AND (objective IS NOT NULL OR gate_status = 'reject')").select(*KEYS)


#: So many pairs of texts are some 60 MB.
_TASK_ROWS = 50_000


def advance(pairs: DataFrame, into: Store, work: Evaluate = evaluate, batches: int = 8) -> int:
    """Evaluates the pairs that the store has no usable row for, batch by batch; how many pairs failed.

    A batch is a share of the pairs by hash, so that what is done of a killed
    run doesn't depend on the order of rows. Where a batch fails, its halves
    are tried again, down to a single pair, which becomes a row with its error
    and stops nobody. Only errors of the evaluation count as such; Spark itself
    repeats the tasks of lost executors. Repeated keys are evaluated once, with
    their least texts.
    """
    version, failed = into.next_version(), 0
    # by number, since few bytes of text are much work here and would be put together in few tasks
    parts = max(int(into.spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // (batches * _TASK_ROWS)))
    spread = F.pmod(F.xxhash64(*KEYS), F.lit(1 << 30))
    pending = [((k << 30) // batches, ((k + 1) << 30) // batches) for k in reversed(range(batches))]
    while pending:
        low, high = pending.pop()
        # what this run has added so far is done too, so a share that is tried again does no pair twice;
        # keys that are done meet the pairs in the one shuffle that also brings repeated pairs together
        known = _usable(into.newest()).withColumn("_done", F.lit(True))
        both = pairs.withColumn("_done", F.lit(False)).unionByName(known, allowMissingColumns=True).where((spread >= low) & (spread < high)).repartition(parts, *KEYS)
        marked = both.groupBy(*KEYS).agg(F.min(F.struct(*(c for c in pairs.columns if c not in KEYS))).alias("_t"), F.max("_done").alias("_done"))
        todo = marked.where(~F.col("_done")).select(*KEYS, "_t.*")
        try:
            into.add(work(todo), version)
        except PySparkException as error:
            if high - low > 1 and todo.select(*KEYS).limit(2).count() > 1:
                half = (low + high) // 2
                pending += [(half, high), (low, half)]
                continue
            into.add(_errors(todo, str(error)), version)
            failed += todo.count()
    return failed


def _errors(pairs: DataFrame, message: str) -> DataFrame:
    cause = next((line for line in reversed(message.splitlines()) if line.strip()), "")[:500]
    return pairs.select(*KEYS, F.lit(None).cast("string").alias("gate_status"), F.array().cast("array<string>").alias("reasons"), F.lit(None).cast(_FINDINGS).alias("objective"), F.lit(cause).alias("error"))


def run(pairs: DataFrame, path: str, final: DataFrame, voices: DataFrame | None = None, *, run_id: str = "run", profile: str = "pilot", scope: str | None = None, limit: int | None = None, work: Evaluate = evaluate, batches: int = 8) -> Run:
    """Evaluates pairs, decides them with the judges' final votes, and gives results, audit rows and a snapshot.

    path: the store of evaluations, kept between runs. A pair whose newest row
    there has the same scope and findings in today's form isn't done again; so a
    run that was killed goes on where it stopped, with the rows of one run.
    limit takes the first pairs by record and model. A pair with an error is
    rejected, with its error in the results. Repeated pairs count once, by their
    least texts; null ids stay what they are.
    """
    pair = votes.PAIR
    rows = pairs.select(*pair, "source_text", "summary_text", F.lit(scope).cast("string").alias("scope"))
    if limit is not None:
        # told by their ids, so that the texts of the others stay where they are
        first = rows.select(*pair).distinct().orderBy(*pair).limit(limit)
        rows = rows.alias("p").join(first.alias("f"), F.col("p.emr_id").eqNullSafe(F.col("f.emr_id")) & F.col("p.model_id").eqNullSafe(F.col("f.model_id")), "left_semi")
    kept = store(rows.sparkSession, path)
    advance(rows, kept, work, batches)
    same = F.col("n.emr_id").eqNullSafe(F.col("p.emr_id")) & F.col("n.model_id").eqNullSafe(F.col("p.model_id")) & F.col("n.scope").eqNullSafe(F.lit(scope))
    once = rows.groupBy(*pair).agg(F.min(F.struct("source_text", "summary_text")).alias("_t")).select(*pair, "_t.*")
    done = once.alias("p").join(kept.newest().alias("n"), same).select("p.*", F.coalesce("n.gate_status", F.lit("reject")).alias("gate_status"), "n.reasons", "n.objective", "n.error")
    results = votes.decide(done, final, voices)
    audit = drift.audit_rows(results, F.lit(run_id)).join(results.select("emr_id", "model_id", "category", "gate_status", "objective", "e1_triggered", "error"), ["emr_id", "model_id"]).withColumn("profile", F.lit(profile))
    return Run(results.drop("source_text", "summary_text").withColumn("verdict", verdict(F.col("step"), F.col("issue_blocks"), F.col("e1_sources"), F.col("error"))), audit, drift.snapshots(audit))


def verdict(step: Column, blocks: Column, sources: Column, error: Column) -> Column:
    """One line on why a pair got its category."""
    told = F.create_map(*(F.lit(x) for kv in lx.VERDICTS.items() for x in kv))
    detail = F.when(step == "stop", F.array_join(sources, ", ")).when(step.isin("rework_confirmed", "systemic", "local"), F.array_join(blocks, ", "))
    return F.when(error.isNotNull(), F.concat(F.lit("error: "), error)).otherwise(F.concat(told[step], F.when(detail != "", F.concat(F.lit(": "), detail)).otherwise(F.lit(""))))
