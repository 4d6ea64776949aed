"""Personal data: plain patterns, and terms that the corpus shows to reveal a protected value (information-theoretic sanitisation).

Everything is made of DataFrame and SQL functions. Patterns tell no places
there, so a text is split at its matches: the lengths of the pieces and of the
matches, summed up, are the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_ids, materialise

KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. Possessive repeats, and beginnings that no
# longer match could have, find the same spans without trying a long run again
# from each of its characters.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = (_EMAIL, _IP, _CARD, _PHONE)
#: What a text with a match of each pattern has at least.
_HINTS = ("@", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){12}", r"\+[0-9]")
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Words of three letters or more that are no part of an address, a name with digits or the like.
TERM = r"(?<![\p{L}\p{M}\p{N}_@.%+-])\p{L}[\p{L}\p{M}]{2,}+(?![\p{N}_@%+-]|\.[\p{L}\p{N}._%+@-])"
#: Code points on either side of a protected value whose terms count as near it.
CONTEXT = 48
#: Different surroundings in which a term must stand near the same value.
SUPPORT = 3
#: Share of a value's information that a term tells: from the first on it is generalised, from the second on removed.
REVEAL, REMOVE = 0.9, 0.99
_MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _q(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    place = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + F.when(place(i) > 9, place(i) - 9).otherwise(place(i)))
    return total % 10 == 0


def _sound(kind: Column, value: Column) -> Column:
    """Whether a match holds what its kind asks for beyond the pattern."""
    digits = _digits(value)
    card = F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.when(kind == 1, value.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$")).when(kind == 2, card).when(kind == 3, F.length(digits).between(9, 15)).otherwise(True)


def _text(documents: DataFrame) -> Column:
    return F.coalesce(documents["text"].cast("string"), F.lit(""))


def _key(text: Column) -> Column:
    """Equal for equal texts."""
    return F.unhex(F.md5(text))


def _found(documents: DataFrame) -> DataFrame:
    """(row, doc_id, key, hits): a row's matches by kind with the pieces between them, without the texts."""
    part = f"p -> named_struct('n', length(p), 'before', right(p, {CONTEXT}), 'after', left(p, {CONTEXT}))"
    kinds = [F.when(F.col("text").rlike(hint), F.expr(f"named_struct('kind', {k}, 'pieces', transform(split(text, {_q(pattern)}, -1), {part}), 'matches', regexp_extract_all(text, {_q(pattern)}, 0))")) for k, (pattern, hint) in enumerate(zip(PATTERNS, _HINTS, strict=True))]
    hits = F.filter(F.array(*kinds), lambda h: F.coalesce(F.size(h["matches"]) > 0, F.lit(False)))
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), _text(documents).alias("text"))
    return materialise(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", _key(F.col("text")).alias("key"), hits.alias("hits")))


def _spans(found: DataFrame) -> DataFrame:
    """(row, key, kind, start, end, value, before, after) of every sound base match."""
    every = found.select("row", "key", F.explode("hits").alias("h")).select("row", "key", F.col("h.kind").alias("kind"), F.col("h.pieces").alias("pieces"), F.posexplode("h.matches").alias("pos", "match"))
    piece, after = F.get("pieces", F.col("pos")), F.get("pieces", F.col("pos") + 1)
    # cut words at the far ends are left out
    left = F.when(piece["n"] > CONTEXT, F.regexp_replace(piece["before"], r"^\S+", "")).otherwise(piece["before"])
    right = F.when(after["n"] > CONTEXT, F.regexp_replace(after["after"], r"\S+$", "")).otherwise(after["after"])
    flat = every.select("row", "key", "kind", "pos", piece["n"].alias("gap"), "match", left.alias("before"), right.alias("after"))
    upto = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    value = F.when(F.col("kind").isin(2, 3), _digits(F.col("match"))).otherwise(F.lower("match"))
    return placed.where(_sound(F.col("kind"), F.col("match"))).select("row", "key", "kind", (F.col("end") - F.length("match")).alias("start"), "end", value.alias("value"), "before", "after")


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def revealing_terms(documents: DataFrame, found: DataFrame, spans: DataFrame) -> DataFrame:
    """(term, reveals): the greatest share of a protected value's information that each term tells, from REVEAL on.

    A term t tells log p(e|t) - log p(e) of the -log p(e) bits of a value e,
    with shares of different texts: p(e) of those with e, p(e|t) of those with
    e near t among those with t. Terms count only if they stand near the value
    in SUPPORT different surroundings, so that copies of a text show nothing.
    Only pairs near a value are rows. A term stands in no fewer texts than near
    any value, so that most are ruled out before texts are read: of all texts
    only what may still reveal is counted.
    """
    value = F.concat_ws(":", "kind", "value").alias("value")
    near = materialise(spans.select("key", value, F.xxhash64("before", "after").alias("around"), F.explode(F.array_union(_terms(F.col("before")), _terms(F.col("after")))).alias("term")))
    # first the surroundings, then the texts: no group is ever collected
    around = near.groupBy("value", "term", "around").agg(F.lit(1).alias("one")).groupBy("value", "term").agg(F.count("*").alias("places"))
    pairs = materialise(around.where(F.col("places") >= SUPPORT).select("value", "term"))
    if pairs.isEmpty():
        return pairs.select("term", F.lit(0.0).alias("reveals"))
    together = near.join(pairs, ["value", "term"], "left_semi").groupBy("value", "term", "key").agg(F.lit(1).alias("one")).groupBy("value", "term").agg(F.count("*").alias("both"))
    values = spans.select("key", value).distinct().groupBy("value").agg(F.count("*").alias("with_value"))
    beside = near.join(broadcast_ids(pairs.select("term").distinct()), "term", "left_semi").select("term", "key").distinct().groupBy("term").agg(F.count("*").alias("with_term"))
    own = F.col("with_value") / F.lit(float(found.select("key").distinct().count()))
    reveals = F.when(own < 1, 1 - F.ln(F.least(F.col("both") / F.col("with_term"), F.lit(1.0))) / F.ln(own))
    likely = materialise(together.join(values, "value").join(beside, "term").where(reveals >= REVEAL).drop("with_term"))
    candidates = materialise(likely.select("term").distinct())
    if candidates.isEmpty():
        return candidates.select("term", F.lit(0.0).alias("reveals"))
    text = _text(documents)
    seen = documents.select(_key(text).alias("key"), F.explode(_terms(text)).alias("term")).join(broadcast_ids(candidates), "term", "left_semi")
    counted = seen.distinct().groupBy("term").agg(F.count("*").alias("with_term"))
    return materialise(likely.join(counted, "term").withColumn("reveals", reveals).groupBy("term").agg(F.max("reveals").alias("reveals")).where(F.col("reveals") >= REVEAL))


def _term_spans(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, start, end, reveals) of every occurrence of the terms in different texts."""
    text = _text(documents)
    texts = documents.select(_key(text).alias("key"), text.alias("text"))
    hit = materialise(texts.select("key", F.explode(_terms(F.col("text"))).alias("term")).join(broadcast_ids(terms.select("term")), "term", "left_semi").select("key").distinct())
    own = texts.join(broadcast_ids(hit), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    lengths, words = f"transform(split(text, {_q(TERM)}, -1), p -> length(p))", f"regexp_extract_all(text, {_q(TERM)}, 0)"
    flat = own.select("key", F.expr(lengths).alias("gaps"), F.expr(words).alias("words")).select("key", "gaps", F.posexplode("words").alias("pos", "word")).select("key", "pos", "word", F.get("gaps", F.col("pos")).alias("gap"))
    upto = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.length("word")).over(upto)).withColumn("term", F.lower("word"))
    return materialise(placed.join(broadcast_ids(terms), "term").select("key", (F.col("end") - F.length("word")).alias("start"), "end", "reveals"))


def _by_kind(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _collected(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    found = _found(documents)
    spans = materialise(_spans(found))
    terms = revealing_terms(documents, found, spans)
    return found, spans, None if terms.isEmpty() else _term_spans(documents, terms)


def scan(documents: DataFrame) -> DataFrame:
    """One row a document: base counts, the digest of its base spans, all spans with those of revealing terms, and n_term.

    Spans count code points of the whole text, ends exclusive, by kind as
    listed in KINDS, then start. Null and empty texts have none. Repeated rows
    are scanned each for itself; equal texts show a term's surroundings once. An
    empty table gives no rows; further columns are ignored.

    Texts are read and never shuffled, but for those with a revealing term.
    Matches are shuffled by row, and a text's spans are all that one group
    holds; terms near values are counted after partial sums.
    """
    found, spans, told = _collected(documents)
    own = F.array_sort(F.collect_list(F.struct("kind", "start", "end")))
    base = spans.groupBy("row").agg(own.alias("base"))
    rows = found.select("row", "doc_id", "key")
    out = rows.join(base, "row", "left").withColumn("base", F.coalesce("base", F.expr("cast(array() AS array<struct<kind:int,start:bigint,end:bigint>>)")))
    if told is None:
        out = out.withColumn("every", F.col("base"))
    else:
        more = materialise(told.withColumn("kind", F.lit(4)).groupBy("key").agg(own.alias("told")))
        out = out.join(broadcast_ids(more) if more.agg(F.sum(F.size("told"))).first()[0] <= 100_000 else more, "key", "left").withColumn("every", F.when(F.col("told").isNull(), F.col("base")).otherwise(F.concat("base", "told")))
    count = lambda k: F.size(F.filter("every", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return out.select("doc_id", *(count(k) for k in range(4)), F.sha2(_by_kind(F.col("base")), 256).alias("base_sha256"), _by_kind(F.col("every")).alias("spans"), count(4))


def sanitise(documents: DataFrame) -> DataFrame:
    """documents with marks in place of base values, revealing terms generalised to their kind of word, or removed.

    All rows and columns stay; a column n_chars follows the new text; nulls and
    texts without a span stay as they are. Overlapping spans become the mark of
    the first. Texts are joined with their spans by content, so equal texts
    change alike.
    """
    found, spans, told = _collected(documents)
    first = spans.join(found.groupBy("key").agg(F.min("row").alias("row")), ["key", "row"], "left_semi").select("key", "kind", "start", "end", F.lit(1.0).alias("reveals"))
    every = first if told is None else first.unionByName(told.withColumn("kind", F.lit(4)))
    # the furthest end before a span, which tells whether it overlaps
    before = Window.partitionBy("key").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    apart = every.withColumn("last", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = materialise(apart.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "last", "end", "kind", "reveals"))).alias("found_spans"), F.max("end").alias("found_end")))
    marks = F.array(*(F.lit(_MARKS.get(k)) for k in KINDS))
    text, names = F.col("own_text"), documents.columns

    def mark(s: Column) -> Column:
        capital = F.substring(text, (s["start"] + 1).cast("int"), F.lit(1)).rlike(r"\p{Lu}")
        general = F.when(capital, F.lit("[NAME]")).otherwise(F.lit("[TERM]"))
        return F.when(s["kind"] < 4, F.get(marks, s["kind"])).when(s["reveals"] >= REMOVE, F.lit("")).otherwise(general)

    def piece(s: Column) -> Column:
        gap = F.substring(text, (s["last"] + 1).cast("int"), (s["start"] - s["last"]).cast("int"))
        return F.when(s["start"] >= s["last"], F.concat(gap, mark(s))).otherwise(F.lit(""))

    new = F.concat(F.array_join(F.transform("found_spans", piece), ""), F.substring(text, (F.col("found_end") + 1).cast("int"), F.length(text)))
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("own_row"), documents["text"].cast("string").alias("own_text"), _key(_text(documents)).alias("key"))
    out = rows.join(broadcast_ids(covered) if covered.agg(F.coalesce(F.sum(F.size("found_spans")), F.lit(0))).first()[0] <= 100_000 else covered, "key", "left")
    changed = out.withColumn("new_text", F.when(F.col("found_spans").isNull(), text).otherwise(new))
    field = F.col("own_row")
    values = [F.col("new_text").alias(c) if c == "text" else F.when(F.col("found_spans").isNull(), field[c]).otherwise(F.length("new_text").cast(documents.schema[c].dataType)).alias(c) if c == "n_chars" else field[c].alias(c) for c in names]
    return changed.select(*values)
