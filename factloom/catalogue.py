"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import edits, facts, judging, monitoring, texts, votes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = facts.QUERIES | votes.QUERIES | monitoring.QUERIES | texts.QUERIES | edits.QUERIES | judging.QUERIES
ORACLE_SQL: dict[str, str] = facts.ORACLE_SQL | votes.ORACLE_SQL | monitoring.ORACLE_SQL | texts.ORACLE_SQL | edits.ORACLE_SQL | judging.ORACLE_SQL
