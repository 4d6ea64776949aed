"""Queries on judges' answers: lines of an order stand for answers on it, written as JSON in better and worse forms.

The expressions are SQL that Spark and DuckDB read alike, so both engines see
the same answers; what a valid one says is computed from the columns beside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..operators import judging
from . import corpus
from . import votes as vote_plans

_ROLE = "CASE l_linenumber % 3 WHEN 0 THEN 'clinician' WHEN 1 THEN 'editor' ELSE 'pharmacist' END"
_BLOCKS = tuple(lx.BLOCKS)
_BLOCK = "CASE l_partkey % 5 " + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(_BLOCKS)) + " END"


def _fails(i: int) -> str:
    return f"(l_partkey + {i} * l_suppkey) % 4 = 0"


def _body(quote: str, yes: str, no: str, last: str | None = None, end: str = "}") -> str:
    """SQL of a block's answer; last replaces the value of the last criterion."""
    whens = []
    for k, (block, n) in enumerate(lx.BLOCKS.items()):
        fields = [f"'{quote}{block}{i}{quote}: {{{quote}pass{quote}: ' || CASE WHEN {_fails(i)} THEN '{no}' ELSE '{yes}' END || ', {quote}comment{quote}: \"part ' || l_partkey || '\"}}'" for i in range(1, n + 1)]
        if last is not None:
            fields[-1] = f"'{quote}{block}{n}{quote}: {last}'"
        whens.append(f"WHEN {k} THEN " + " || ', ' || ".join(fields))
    return f"'{{' || CASE l_partkey % 5 {' '.join(whens)} END || '{end}'"


_JSON = _body('"', "true", "false")
#: Strict, fenced, behind thoughts with a comma too many; cut off, without a boolean, prose, none; bare keys.
_RAW = f"""CASE CAST(l_quantity AS INT) % 8 WHEN 0 THEN {_JSON} WHEN 1 THEN '```json ' || {_JSON} || ' ```' WHEN 2 THEN '<think>{{x}}</think>' || {_body('"', "true", "false", None, ",}")}
WHEN 3 THEN {_body('"', "true", "false", '{"pass": tr', "")} WHEN 4 THEN {_body('"', "true", "false", '{"pass": "yes"}')} WHEN 5 THEN 'I would not judge part ' || l_partkey WHEN 6 THEN NULL ELSE {_body("", "True", "False")} END"""
_ANSWER = ("CAST(l_orderkey AS STRING) AS emr_id", "CAST(l_orderkey % 6 AS STRING) AS model_id", "1 AS round", f"{_ROLE} AS role", f"{_BLOCK} AS block", "CAST(l_suppkey % 4 + 1 AS INT) AS attempt", f"{_RAW} AS raw")
_LINES = f"SELECT {', '.join(_ANSWER)}, CAST(l_quantity AS INT) % 8 NOT IN (3, 4, 5, 6) AS fine, l_partkey, l_suppkey FROM lineitem"
_BEST = f"SELECT * FROM (SELECT *, max(attempt) OVER (PARTITION BY emr_id, role, block) AS attempts, row_number() OVER (PARTITION BY emr_id, role, block ORDER BY NOT fine, CASE WHEN fine THEN attempt ELSE -attempt END, coalesce(raw, '')) AS place FROM ({_LINES})) WHERE place = 1"
_TASKS = f"SELECT emr_id, model_id, role, block FROM (SELECT emr_id, model_id FROM ({corpus.GATES}) WHERE gate_status <> 'reject') CROSS JOIN (VALUES {', '.join(f'({chr(39)}{r}{chr(39)})' for r in corpus.ROLES)}) AS roles(role) CROSS JOIN (VALUES {', '.join(f'({chr(39)}{b}{chr(39)})' for b in _BLOCKS)}) AS blocks(block)"
_STATE = f"SELECT t.emr_id, t.model_id, t.role, t.block, b.attempts, b.fine, b.l_partkey, b.l_suppkey FROM ({_TASKS}) t LEFT JOIN ({_BEST}) b USING (emr_id, role, block)"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*_ANSWER)


def _panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that are asked, with what counts of their answers."""
    gated = corpus.frame(spark, sf_dir, corpus.GATES)
    return judging.panels(gated, corpus.ROLES, _answers(spark, sf_dir), corpus.tasks(spark.read.parquet(f"{sf_dir}/orders.parquet")))


def answer_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each pair's judges voted, by block: votes, failed ones by criterion and role, and blocks of judges without data."""
    count = lambda votes_: F.size(F.flatten(votes_)) * F.col("n")
    failed = F.transform(judging.failed_by(F.col("given"), F.col("block")), lambda x: F.concat_ws("/", x["code"], x["role"]))
    each = judging.panel_blocks(_panels(spark, sf_dir), corpus.ROLES).select(
        "emr_id", "block", count(F.transform("given", lambda t: t["votes"])).alias("votes"), count(F.transform("given", lambda t: F.filter(t["votes"], lambda v: v))).alias("passed"), F.flatten(F.array_repeat(failed, F.col("n"))).alias("failed"), "without"
    )
    rows = each.groupBy("emr_id", "block").agg(F.sum("votes").cast("long").alias("n_votes"), F.sum("passed").cast("long").alias("n_passed"), F.array_join(F.array_sort(F.flatten(F.collect_list("failed"))), ",").alias("failed"), F.size(F.array_distinct(F.flatten(F.collect_list("without")))).cast("long").alias("n_without"))
    return rows.where("n_votes > 0")


def answers_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks that are asked again because an answer was broken."""
    first = judging.block_answers(_answers(spark, sf_dir), True).select(*judging.TASK, "attempts", "valid")
    return judging.pending_of(judging.asked(corpus.frame(spark, sf_dir, corpus.GATES), corpus.ROLES, first)).where("short").drop("place", "short")


def block_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the judges say on failed criteria."""
    return judging.panel_comments(_panels(spark, sf_dir), corpus.ROLES)


def verdict_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every final decision in words."""
    done = judging.verdicts(vote_plans._decided(spark, sf_dir), vote_plans._blocks(spark, sf_dir))
    return done.select("emr_id", "model_id", "category", "verdict")


QUERIES = {f.__name__: f for f in (answer_votes, answers_pending, block_comments, verdict_texts)}

_SIZES = "CASE block " + " ".join(f"WHEN '{b}' THEN {n}" for b, n in lx.BLOCKS.items()) + " END"
_CODES = f"SELECT emr_id, model_id, role, block, block || i AS code, l_partkey, CASE WHEN fine THEN (l_partkey + i * l_suppkey) % 4 <> 0 END AS pass, fine FROM ({_STATE}) CROSS JOIN range(1, 6) AS n(i) WHERE i <= {_SIZES}"


def _said(form: str, *values: str) -> str:
    """SQL of a text in which each %s stands for an expression."""
    first, *rest = form.split("%s")
    return " || ".join([f"'{first}'", *(f"{value} || '{piece}'" for value, piece in zip(values, rest, strict=True))])


_FAILED, _OPEN = (_said(form, "block", f"replace({codes}, ',', ', ')") for form, codes in ((lx.ISSUE_FAILED, "failed"), (lx.ISSUE_OPEN, "undetermined")))
_PART = f"CASE WHEN failed <> '' THEN {_FAILED} ELSE {_OPEN} END"
_LISTED = f"SELECT emr_id, model_id, string_agg({_PART}, '; ' ORDER BY block) AS listed FROM ({vote_plans._BLOCKS}) WHERE status <> 'ok' GROUP BY ALL"

ORACLE_SQL = {
    "answer_votes": f"""SELECT emr_id, block, count(pass) AS n_votes, count_if(pass) AS n_passed, coalesce(string_agg(code || '/' || role, ',' ORDER BY code || '/' || role) FILTER (NOT pass), '') AS failed, count(DISTINCT role) FILTER (fine IS DISTINCT FROM true) AS n_without
        FROM ({_CODES}) GROUP BY emr_id, block HAVING count(pass) > 0""",
    "answers_pending": f"SELECT emr_id, model_id, role, block, CAST(attempts + 1 AS INT) AS attempt FROM ({_STATE}) WHERE NOT fine AND attempts < 4",
    "block_comments": f"""SELECT emr_id, model_id, block, string_agg(code || '/' || role || ': part ' || l_partkey, '; ' ORDER BY code, role) AS comments FROM ({_CODES})
        JOIN (SELECT emr_id, code FROM ({_CODES}) GROUP BY ALL HAVING count(pass) > 0 AND 2 * count_if(pass) <= count(pass)) USING (emr_id, code) WHERE NOT pass GROUP BY emr_id, model_id, block""",
    "verdict_texts": f"""SELECT emr_id, model_id, category, CASE WHEN gate_status = 'reject' THEN {_said(lx.VERDICT_GATE, "''")} WHEN category = '{lx.REJECT}' AND e1_sources <> '' THEN {_said(lx.VERDICT_STOP, 'category', "replace(e1_sources, ',', ', ')")}
        WHEN issue_blocks = '' THEN {_said(lx.VERDICT_CLEAN, 'category')} ELSE {_said(lx.VERDICT_ISSUES, 'category', 'listed')} END AS verdict FROM ({vote_plans._DECIDED}) LEFT JOIN ({_LISTED}) USING (emr_id, model_id)""",
}
