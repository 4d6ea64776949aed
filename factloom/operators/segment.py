"""Sections of records and summaries, and how well they follow the schema. Each document is cut in place by array functions; nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.text import unnested

SECTIONS = "array<struct<ord:int,category:string,title:string,body:string,visit_date:string>>"
OTHER = "other"


def _bare(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(line), r'^"+|"+$', ""))


def header(bare: Column) -> Column:
    """The section that a heading line opens, "noise" for lines of the visit's metadata, else null."""
    like = (F.length(bare) > 0) & (F.length(bare) <= 80) & ~bare.endswith(".") & bare.rlike(r"^\p{Lu}")
    norm = F.lower(F.rtrim(F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+", " "), r":+$", "")))
    # told of one line at a time, so that the line is put in its normal form once and not for each pattern
    of = lambda n: _first((("noise", lx.NOISE), *lx.HEADERS), n)
    return F.when(like, F.get(F.transform(F.filter(F.array(norm), lambda n: n != ""), of), 0))


def _first(patterns: tuple[tuple[str, str], ...], text: Column, otherwise: str | None = None) -> Column:
    out = F.lit(otherwise).cast("string")
    for name, pattern in reversed(patterns):
        out = F.when(text.rlike(f"(?U){pattern}"), F.lit(name)).otherwise(out)
    return out


def summary_category(title: Column) -> Column:
    """The section that a summary's heading names by its key words, else "other"."""
    norm = F.regexp_replace(F.lower(F.regexp_replace(F.trim(title), r"^[:*# ]+|[:*# ]+$", "")), r"^\d{1,2}[.)]\s*", "")
    return F.get(F.transform(F.array(norm), lambda n: _first(lx.SUMMARY_KEYWORDS, n, OTHER)), 0)


def summary_header(line: Column) -> Column:
    """struct<title, category, rest> of a heading in a summary, else null: marked, bold, numbered or plain on its own line, or a label with its text.

    A plain label, and any label with text, counts only where its key words name a section.
    """
    bare = F.trim(line)
    unlisted = F.regexp_replace(bare, lx.BULLET, "")
    text = F.when((unlisted != bare) & unlisted.startswith("**"), unlisted).otherwise(bare)

    def read(t: Column) -> Column:
        """The first form that fits, with what it has to meet; its section is told once."""
        group = lambda p, k: F.trim(F.regexp_extract(t, f"(?U){p}", k))
        form = lambda p, rest, known, longest: F.when(t.rlike(f"(?U){p}"), F.struct(group(p, 1).alias("title"), rest.alias("rest"), F.lit(known).alias("known"), F.lit(longest).alias("longest")))
        alone = F.array_compact(F.array(*(form(p, F.lit(None).cast("string"), name == "plain", 120) for name, p in lx.SUMMARY_ALONE)))
        beside = F.array_compact(F.array(*(form(p, group(p, 2), True, 60) for p in lx.SUMMARY_WITH_TEXT)))
        forms = F.slice(F.concat(F.filter(alone, lambda f: F.length(f["title"]).between(1, 120)), beside), 1, 1)
        told = F.transform(forms, lambda f: F.struct(f["title"].alias("title"), summary_category(f["title"]).alias("category"), f["rest"].alias("rest"), f["known"].alias("known"), f["longest"].alias("longest")))
        good = F.filter(told, lambda f: (~f["known"] | (f["category"] != OTHER)) & F.length(f["title"]).between(1, f["longest"]))
        return F.get(F.transform(good, lambda f: F.struct(f["title"].alias("title"), f["category"].alias("category"), f["rest"].alias("rest"))), 0)

    return F.get(F.transform(F.array(text), read), 0)


def _cut(rows: DataFrame) -> Column:
    """The sections of _lines (i, line, title, category, rest, date, skip): from one line with a category to the next; ord 0 is what stands before the first."""

    def section(k: Column) -> Column:
        start, end = F.get("_starts", k), F.coalesce(F.get("_starts", k + 1), F.size("_lines"))
        head = F.get("_lines", start)
        own = F.filter(F.slice("_lines", start + 2, end - start - 1), lambda m: ~m["skip"])
        dated = F.filter(F.slice("_lines", F.lit(1), end), lambda m: m["date"].isNotNull())
        texts = F.array_compact(F.concat(F.array(head["rest"]), F.transform(own, lambda m: m["line"])))
        body = F.regexp_replace(F.array_join(texts, "\n"), r"^\s+|\s+$", "")
        return F.struct(k.cast("int").alias("ord"), head["category"].alias("category"), head["title"].alias("title"), body.alias("body"), F.get(dated, F.size(dated) - 1)["date"].alias("visit_date"), end.alias("end"))

    every = F.transform(F.sequence(F.lit(0), F.size("_starts") - 1), section)
    return F.transform(F.filter(every, lambda s: (s["ord"] > 0) | (s["end"] > 0)), lambda s: F.struct(*(s[c].alias(c) for c in ("ord", "category", "title", "body", "visit_date"))))


def _sectioned(documents: DataFrame, text: str, line: Column) -> DataFrame:
    lines = documents.withColumn("_lines", line)
    opens = F.filter("_lines", lambda m: m["category"].isNotNull())
    starts = lines.withColumn("_starts", F.concat(F.array(F.lit(-1)), F.transform(opens, lambda m: m["i"])))
    return starts.withColumn("_cut", F.when(F.col(text).isNotNull(), _cut(starts)))


def _record_lines(text: str) -> Column:
    none = F.lit(None).cast("string")
    read = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line"), _bare(x).alias("bare"), F.nullif(F.regexp_extract(F.trim(x), lx.VISIT_DATE, 1), F.lit("")).alias("date")))
    told = F.transform(read, lambda m: F.struct(m["i"].alias("i"), m["line"].alias("line"), m["bare"].alias("bare"), m["date"].alias("date"), F.when(m["date"].isNull(), header(m["bare"])).alias("head")))
    return F.transform(
        told,
        lambda m: F.struct(
            m["i"].alias("i"), m["line"].alias("line"), F.when(m["head"] != "noise", m["bare"]).alias("title"), F.when(m["head"] != "noise", m["head"]).alias("category"), none.alias("rest"), m["date"].alias("date"),
            (m["date"].isNotNull() | F.coalesce(m["head"] == "noise", F.lit(False))).alias("skip"),
        ),
    )


def _summary_lines(text: str) -> Column:
    none = F.lit(None).cast("string")
    read = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line"), summary_header(x).alias("head")))
    return F.transform(read, lambda m: F.struct(m["i"].alias("i"), m["line"].alias("line"), m["head"]["title"].alias("title"), m["head"]["category"].alias("category"), m["head"]["rest"].alias("rest"), none.alias("date"), F.lit(False).alias("skip")))


def inline_sections(text: Column) -> Column:
    """The sections that labels within running text open ("Label: text"), as an array like SECTIONS; those whose label names no section belong to the text before.

    ord 0 is what stands before the first label; empty where no label names a section.
    """
    marked = F.regexp_replace(text, f"(?m){lx.INLINE_LABEL}", "\u0001$0\u0002$1\u0003")
    piece = lambda p, i: F.struct(
        i.alias("i"), F.regexp_replace(p, "\u0002.*?\u0003", "").alias("whole"), F.trim(F.regexp_extract(p, "\u0002(.*?)\u0003", 1)).alias("label"), F.regexp_replace(p, "(?s)^.*\u0003", "").alias("rest"), F.contains(p, F.lit("\u0003")).alias("labelled")
    )
    told = F.transform(F.transform(F.split(marked, "\u0001"), piece), lambda p: F.struct(p["i"].alias("i"), p["whole"].alias("whole"), p["label"].alias("label"), p["rest"].alias("rest"), F.when(p["labelled"], F.nullif(summary_category(p["label"]), F.lit(OTHER))).alias("category")))
    trimmed = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")

    def cut(pieces: Column) -> Column:
        starts = F.concat(F.array(F.lit(-1)), F.transform(F.filter(pieces, lambda p: p["category"].isNotNull()), lambda p: p["i"]))

        def section(k: Column) -> Column:
            start, end = F.get(starts, k), F.coalesce(F.get(starts, k + 1), F.size(pieces))
            head = F.get(pieces, start)
            body = F.array_join(F.array_compact(F.concat(F.array(head["rest"]), F.transform(F.slice(pieces, start + 2, end - start - 1), lambda p: p["whole"]))), "")
            return F.struct(k.cast("int").alias("ord"), head["category"].alias("category"), head["label"].alias("title"), trimmed(body).alias("body"), F.lit(None).cast("string").alias("visit_date"))

        return F.when(F.size(starts) > 1, F.transform(F.sequence(F.lit(0), F.size(starts) - 1), section)).otherwise(F.array().cast(SECTIONS))

    return F.get(F.transform(F.array(told), cut), 0)


def sections(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ord, category, title, body, visit_date): ord 0 with no category is what stands before the first heading.

    A section carries the visit date that holds when it ends. Metadata and
    date lines belong to no section. Where headings cover under three tenths of
    a text, labels within it are tried, and count if they cover more. Null texts
    have no sections.
    """
    rows = _sectioned(documents.select(key, text), text, _record_lines(text))
    size = lambda c: F.aggregate(F.filter(c, lambda s: s["ord"] > 0), F.lit(0), lambda n, s: n + F.length(s["body"]))
    rows = rows.withColumn("_covered", size(F.col("_cut"))).withColumn("_inline", F.when(F.col("_covered") < 0.3 * F.greatest(F.length(text), F.lit(1)), inline_sections(F.col(text))))
    chosen = F.when(size(F.col("_inline")) > F.col("_covered"), F.col("_inline")).otherwise(F.col("_cut"))
    return unnested(rows, chosen, "s", key).select(key, "s.*")


def summary_sections(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ord, category, title, body) of summaries, whose headings are told by their form and placed by key words; ord 0 is what stands before the first."""
    rows = _sectioned(documents.select(key, text), text, _summary_lines(text))
    return unnested(rows, "_cut", "s", key).select(key, "s.ord", "s.category", "s.title", "s.body")


def text_for(sections: DataFrame, key: str) -> DataFrame:
    """(key, category, text): all of a category's sections that have text, in order, with an empty line between."""
    full = sections.where("ord > 0 AND body <> ''").groupBy(key, "category").agg(F.array_sort(F.collect_list(F.struct("ord", "body"))).alias("own"))
    return full.select(key, "category", F.array_join(F.transform("own", lambda s: s["body"]), "\n\n").alias("text"))


def compliance(sections: DataFrame, key: str) -> DataFrame:
    """(key, present, missing, in_order, complete): which sections of the schema have text, and whether they keep its order."""
    schema = F.array(*map(F.lit, lx.SCHEMA_SECTIONS))
    full = F.when((F.col("body") != "") & F.col("category").isin(*lx.SCHEMA_SECTIONS), F.struct("ord", "category"))
    seen = sections.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(full)), lambda s: s["category"])).alias("seen"))
    present = F.array_intersect(schema, F.col("seen"))
    return seen.select(key, present.alias("present"), F.array_except(schema, F.col("seen")).alias("missing"), (present == F.col("seen")).alias("in_order"), (F.size(present) >= lx.MIN_SCHEMA_SECTIONS).alias("complete"))
