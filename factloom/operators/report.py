"""The whole objective report of a pair: facts and entities, its findings as rows of text, and what the rules detect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx
from . import entities
from .compare import compare, flags, wrongs


def objective_report(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text") -> DataFrame:
    """pairs with the columns of compare, entities, findings and signals.

    Entities are compared where pairs has entities_a and entities_b, maps of
    category to names that an extractor found; without them entities is null
    and no signal. All is done row by row without a shuffle. Null and empty
    texts and maps have no findings of their own; repeated rows are told each
    for itself; further columns stay.
    """
    done = compare(pairs, source, summary)
    if {"entities_a", "entities_b"} <= set(pairs.columns):
        done = entities.compared(done, source, summary)
    else:
        done = done.withColumn("entities", F.lit(None).cast(entities.ENTITIES))
    missing = F.flatten(F.transform("entities", lambda e: F.transform(e["missing"], lambda name: F.struct(e["category"].alias("category"), name.alias("name")))))
    return done.withColumns({"findings": findings(F.col("objective"), missing), "signals": signals(F.col("objective"), entities.changed(F.col("entities")))})


def alarms(pairs: DataFrame, source: str = "source_text", summary: str = "summary_text") -> DataFrame:
    """pairs with the findings and signals of objective_report alone.

    What is right is neither matched nor told, and all is found in one pass over the texts.
    """
    if {"entities_a", "entities_b"} <= set(pairs.columns):
        done, missing, changed = wrongs(pairs, source, summary, _lost=entities.lost_names(source, summary)), F.col("_lost.missing"), F.col("_lost.changed")
    else:
        done, missing, changed = wrongs(pairs, source, summary), F.lit(None).cast("array<struct<category:string,name:string>>"), F.lit(None).cast("boolean")
    return done.withColumns({"findings": findings(F.col("objective"), missing), "signals": signals(F.col("objective"), changed)}).drop("objective", "_lost")


def findings(objective: Column, missing: Column) -> Column:
    """array<struct<kind, told>>: what a judge must weigh. Extra entities are none, as a good summary may name what its source describes."""

    def rows(kind: str, items: Column, *parts) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), F.format_string(lx.FINDINGS[kind], *(part(x) for part in parts)).alias("told")))

    def cited(kind: str, items: Column, contexts: Column) -> Column:
        quoted = lambda x: F.concat(F.lit("«"), F.replace(x["raw"], F.lit(" → "), F.lit("» -> «")), F.lit("»"))
        return rows(kind, F.zip_with(items, contexts, lambda raw, context: F.struct(raw.alias("raw"), context.alias("context"))), quoted, lambda x: x["context"])

    number, polarity, causality = objective["numeric"], objective["polarity"], objective["causality"]
    markers = F.when(causality["introduced"] > 0, F.array(F.array_join(causality["introduced_markers"], ", "))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<kind:string,told:string>>")
    return F.concat(
        cited("number", number["mismatches"], number["mismatch_contexts"]),
        cited("unit", number["unit_mismatches"], number["unit_mismatch_contexts"]),
        cited("polarity", polarity["flips"], polarity["flip_contexts"]),
        rows("causality", markers, lambda m: m),
        rows("interpretation", objective["interpretation"]["contradictions"], lambda c: c["fragment"], lambda c: c["claimed"], lambda c: c["actual"]),
        F.coalesce(rows("entity", missing, lambda m: m["category"], lambda m: m["name"]), none),
    )


def signals(objective: Column, changed: Column) -> Column:
    """The kinds of finding that the rules caught, in the order of lexicons.SIGNALS."""
    caught = flags(objective) | {"caught_entity": F.coalesce(changed, F.lit(False))}
    return F.array_compact(F.array(*(F.when(caught[f"caught_{s}"], s) for s in lx.SIGNALS)))


def detection_summary(found: DataFrame, *by: str) -> DataFrame:
    """found (signals, severity and the columns by) counted by severity and by, and over all (a rollup: nulls stand for all).

    n, n_flagged, rate and its name (recall of critical rows, false positive
    rate of the others), and n_<signal> for each signal; a row may have several.
    """
    has = {f"n_{s}": F.count_if(F.array_contains("signals", s)) for s in lx.SIGNALS}
    counts = found.rollup("severity", *by).agg(F.count("*").alias("n"), F.count_if(F.size("signals") > 0).alias("n_flagged"), *(c.alias(name) for name, c in has.items()))
    return counts.withColumns({"rate": F.round(F.col("n_flagged") / F.col("n"), 4), "rate_label": F.when(F.col("severity") == "critical", "recall").when(F.col("severity").isNotNull(), "FPR")})


def detection_errors(found: DataFrame) -> DataFrame:
    """The rows of found that the rules judge wrongly, with kind: critical ones without a signal (miss), others with one (false_alarm)."""
    critical, flagged = F.col("severity") == "critical", F.size("signals") > 0
    return found.withColumn("kind", F.when(critical & ~flagged, "miss").when(~critical & flagged, "false_alarm")).where("kind IS NOT NULL")
