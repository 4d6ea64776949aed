"""Coverage rules that decide whether a summary is looked at at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx


def _reason(code: Column, severity: Column | str) -> Column:
    return F.struct(code.alias("code"), (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"))


def _gone(a: Column, b: Column, critical: tuple[str, ...], code: str) -> Column:
    """Critical kinds that occur in a and nowhere in b."""
    lost = F.array_except(F.array_intersect(F.array(*map(F.lit, critical)), a), b)
    return F.transform(lost, lambda x: _reason(F.concat(F.lit(code), x), "reject"))


def counts(facts: Column, field: str) -> Column:
    """array<struct<key, n>>: how often each value of a field occurs, in the order of first occurrence."""
    values = F.transform(facts, lambda f: f[field])
    return F.transform(F.array_distinct(values), lambda v: F.struct(v.alias("key"), F.size(F.filter(values, lambda x: x == v)).alias("n")))


def gate(facts: DataFrame, scope: Column | None = None, entities: Column | None = None) -> DataFrame:
    """facts (see compare.with_facts, or with_kinds) with gate: struct<status, reasons array<struct<code, severity>>>.

    Without a scope every critical kind of number or statement in the source
    must occur in the summary. entities are those of entities.compared:
    without a scope a critical category that is not covered at all rejects;
    with one any category below the least recall asks for rework, or rejects
    where nothing is covered. status: reject if any reason does, else rework if
    there is one, else pass.
    """
    scope = F.lit(None).cast("string") if scope is None else scope
    none = F.array().cast("array<struct<code:string,severity:string>>")
    # kinds, where they are there, spare the facts
    kind = lambda name, field: F.col(f"kinds.{name}") if "kinds" in facts.columns else F.transform(name, lambda f: f[field])
    sides = lambda name, field: (kind(f"{name}_a", field), kind(f"{name}_b", field))
    plain = F.concat(_gone(*sides("numbers", "category"), lx.CRITICAL_NUMBERS, "numeric_coverage_low:"), _gone(*sides("statements", "predicate"), lx.CRITICAL_PREDICATES, "predicate_coverage_low:"))
    reasons = F.when(scope.isNull(), plain).otherwise(none)
    if entities is not None:
        nothing = lambda e: e["recall"] == 0
        of = lambda test, code, severity: F.transform(F.filter(entities, lambda e: (e["in_a"] > 0) & test(e)), lambda e: _reason(F.concat(F.lit(code), e["category"]), severity(e)))
        whole = of(lambda e: nothing(e) & e["category"].isin(*lx.CRITICAL_ENTITIES), "entity_recall_zero:", lambda e: "reject")
        scoped = of(lambda e: e["recall"] < lx.MIN_ENTITY_RECALL, "entity_recall_low:", lambda e: F.when(nothing(e), "reject").otherwise("rework"))
        reasons = F.concat(reasons, F.coalesce(F.when(scope.isNull(), whole).otherwise(scoped), none))
    status = F.when(F.exists("_reasons", lambda r: r["severity"] == "reject"), "reject").when(F.size("_reasons") > 0, "rework").otherwise("pass")
    return facts.withColumn("_reasons", reasons).withColumn("gate", F.struct(status.alias("status"), F.col("_reasons").alias("reasons"))).drop("_reasons")
