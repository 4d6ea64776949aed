"""Queries on texts as such: sections, similarity, entities, answers of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.text import unnested
from ..operators import answers, entities, segment, similarity
from ..operators.gate import gate
from ..sources import charsets, tables
from . import corpus

#: A record in lines, from the keys of an order; a third of them lacks a section, and a third has two in the other order.
_RECORD = """SELECT CAST(o_orderkey AS STRING) AS emr_id, 'Карта ' || o_orderkey || chr(10) || '10 апр ' || (2000 + o_orderkey % 25) || chr(10) || 'Жалобы:' || chr(10) || 'боли в сердце ' || o_custkey || chr(10) ||
CASE WHEN o_orderkey % 3 = 0 THEN 'Общий анализ крови' || chr(10) || 'гемоглобин ' || (90 + o_orderkey % 90) || ' г/л' || chr(10) || 'Анамнез жизни' || chr(10) || 'курение' || chr(10)
  WHEN o_orderkey % 3 = 1 THEN 'Анамнез жизни' || chr(10) || 'курение' || chr(10) || 'Общий анализ крови' || chr(10) || 'гемоглобин ' || (90 + o_orderkey % 90) || ' г/л' || chr(10) ELSE '' END ||
'Осмотр кардиолога' || chr(10) || 'Заключение' || chr(10) || 'состояние среднее' AS text FROM orders"""
_ENTITIES = """SELECT CAST(o_orderkey AS STRING) AS emr_id, map('diagnoses', array('инфаркт миокарда', 'гипертония'), 'medications', array('морфин')) AS entities_a,
map('diagnoses', CASE WHEN o_orderkey % 4 = 0 THEN array('инфаркт') WHEN o_orderkey % 4 = 1 THEN array('гипертония', 'инфаркт миокарда') ELSE array('пневмония') END, 'medications', CASE WHEN o_orderkey % 5 = 0 THEN array() ELSE array('морфин') END) AS entities_b FROM orders"""

#: Names with their texts: every fourth summary leaves a drug out, every third extraction overlooks one, every fifth makes up a symptom; a misspelt diagnosis is the same.
_GROUNDED = """SELECT CAST(k AS STRING) AS emr_id, CASE WHEN k % 2 = 0 THEN 'radiologist' END AS scope,
'Инфаркт миокарда. Назначен морфин ' || (5 + k % 10) || ' мг и аспирин. Жалобы на одышку.' AS source_text,
'Инфаркт ' || CASE WHEN k % 7 = 0 THEN 'миакарда' ELSE 'миокарда' END || '. ' || CASE WHEN k % 4 = 0 THEN 'Терапия скорректирована.' ELSE 'Назначен морфин внутривенно.' END || CASE WHEN k % 11 = 0 THEN ' Пневмония.' ELSE '' END AS summary_text,
map('diagnoses', array('инфаркт миокарда.'), 'medications', array('Морфин', 'определение аспирина'), 'symptoms', CASE WHEN k % 5 = 0 THEN array('одышка', 'тошнота') ELSE array('одышка') END) AS entities_a,
map('diagnoses', CASE WHEN k % 11 = 0 THEN array('инфаркт миокарда', 'пневмония') WHEN k % 7 = 0 THEN array('инфаркт миакарда') ELSE array('инфаркт миокарда') END,
  'medications', CASE WHEN k % 4 = 0 OR k % 3 = 0 THEN array() ELSE array('морфин') END) AS entities_b FROM (SELECT o_orderkey AS k FROM orders) AS keys"""

#: Summaries in five styles of heading, and records in one paragraph.
_SUMMARY = """SELECT CAST(k AS STRING) AS emr_id, CASE k % 5
WHEN 0 THEN '## Жалобы' || chr(10) || 'боль ' || k || chr(10) || '### Анамнез заболевания ##' || chr(10) || 'давно' || chr(10) || '# Прочее' || chr(10) || 'разное'
WHEN 1 THEN 'Вступление' || chr(10) || '**Жалобы:** боль ' || k || chr(10) || '* **Диагноз:** инфаркт' || chr(10) || 'Боль: тупая'
WHEN 2 THEN '1. Жалобы' || chr(10) || 'боль ' || k || chr(10) || '2) Анамнез жизни:' || chr(10) || 'курит' || chr(10) || '3. Лабораторные данные' || chr(10) || 'Hb 120'
WHEN 3 THEN 'Жалобы пациента:' || chr(10) || 'боль ' || k || chr(10) || 'Лечение: морфин' || chr(10) || 'Возраст: 60'
ELSE '**Лабораторные данные**' || chr(10) || 'Hb ' || k || chr(10) || '**Жалобы.**' || chr(10) || 'нет' END AS text FROM (SELECT o_orderkey AS k FROM orders) AS keys"""
_NARRATIVE = """SELECT CAST(k AS STRING) AS emr_id, 'Пациент ' || k || ' поступил. Жалобы: боли в сердце, одышка. Цвет – обычный. Вредные привычки – курит ' || (k % 40) || ' лет. Общий анализ крови: гемоглобин 115 г/л.' AS text FROM (SELECT o_orderkey AS k FROM orders) AS keys"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.sections(corpus.frame(spark, sf_dir, _RECORD), "emr_id")


def segment_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("emr_id", F.col("ord").cast("int").alias("ord"), "category", "title", "body", "visit_date")


def schema_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.compliance(_records(spark, sf_dir), "emr_id").select("emr_id", F.array_join("present", ",").alias("present"), F.array_join("missing", ",").alias("missing"), "in_order", "complete")


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.summary_sections(corpus.frame(spark, sf_dir, _SUMMARY), "emr_id")


def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summaries(spark, sf_dir)


def summary_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.compliance(_summaries(spark, sf_dir), "emr_id").select("emr_id", F.array_join("present", ",").alias("present"), F.array_join("missing", ",").alias("missing"), "in_order", "complete")


def inline_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of records that are one paragraph with labels in it."""
    return segment.sections(corpus.frame(spark, sf_dir, _NARRATIVE), "emr_id").drop("visit_date")


def text_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.text_for(_records(spark, sf_dir), "emr_id")


def section_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir).where("ord > 0").groupBy("category").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("n_chars"))
    schema = spark.createDataFrame([(c, k) for k, c in enumerate(lx.SCHEMA_SECTIONS)], "category string, schema_ord int")
    return schema.join(rows, "category", "left").na.fill(0, ["n", "n_chars"])


def entity_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unnested(entities.compared(corpus.frame(spark, sf_dir, _ENTITIES)), "entities", "e", "emr_id")
    return rows.select("emr_id", *(f"e.{c}" for c in ("category", "in_a", "in_b", "matched", "precision", "recall", "f1")))


def _grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.compared(corpus.frame(spark, sf_dir, _GROUNDED), "source_text", "summary_text")


def entity_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that an extractor made up, overlooked, or rightly found, against the texts."""
    rows = unnested(_grounded(spark, sf_dir), "entities", "e", "emr_id").where("e.in_a + e.in_b > 0")
    return rows.select("emr_id", "e.category", "e.in_a", "e.in_b", "e.matched", F.array_join("e.missing", ",").alias("missing"), F.array_join("e.extra", ",").alias("extra"), "e.precision", "e.recall", "e.f1")


def entity_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first words of a turn come up, by their stems, in the turn after it."""
    turns = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.array_join(F.slice(F.regexp_extract_all("text", F.lit("([a-z0-9]+)")), 1, 2), " ").alias("name"))
    tokens = F.regexp_extract_all("text", F.lit("([a-z0-9]+)"))
    return turns.join(before, ["conv_id", "turn"]).select("conv_id", "turn", "name", entities.present(F.col("name"), tokens).alias("present"))


def gate_with_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's reasons from entities alone, for summaries with and without a declared reader."""
    rows = _grounded(spark, sf_dir)
    empty = {c: F.array().cast("array<struct<category:string,predicate:string>>") for c in ("numbers_a", "numbers_b", "statements_a", "statements_b")}
    done = gate(rows.withColumns(empty), F.col("scope"), F.col("entities"))
    return done.select("emr_id", "scope", F.col("gate.status").alias("gate_status"), F.array_join(F.transform("gate.reasons", lambda r: r["code"]), ",").alias("codes"))


def entity_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grounded(spark, sf_dir).select("emr_id", entities.changed(F.col("entities")).alias("changed"))


def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each answer of a conversation against the turn before it."""
    turns = tables.read(spark, sf_dir, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    return similarity.rouge_l(turns.join(before, ["conv_id", "turn"]), "asked", "text").select("conv_id", "turn", "lcs", "precision", "recall", "f1")


def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties, some of them broken the way models break JSON, read again."""
    raw = F.col("props")
    broken = F.when(F.col("event_id") % 4 == 0, raw).when(F.col("event_id") % 4 == 1, F.regexp_replace(raw, '"', "'")).when(F.col("event_id") % 4 == 2, F.concat(F.lit("```json\n"), F.regexp_replace(raw, "\\}", ",}"), F.lit("```"))).otherwise(F.regexp_replace(raw, "\\}", ""))
    rows = tables.read(spark, sf_dir, "events").select("event_id", broken.alias("answer"))
    return answers.parsed(rows, "answer", "k long").select("event_id", F.col("parsed.k").alias("k"))


#: Texts whose Latin-1 bytes are also those of the Western charset, and which have upper bytes, but no more than letters.
_LATIN = "^[\\x00-\\x7F\\xA0-\\xFF]*$"


def document_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as UTF-8, UTF-16 or Latin-1 bytes, as its characters and id allow, and read again without knowing which."""
    latin = F.col("text").rlike(_LATIN) & (F.col("doc_id") % 3 == 2)
    content = F.when(F.col("doc_id") % 3 == 1, F.encode("text", "UTF-16LE")).when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    files = tables.read(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return charsets.decoded(files).select("doc_id", "charset", F.md5("text").alias("text_md5"))


QUERIES = {f.__name__: f for f in (segment_source, schema_compliance, segment_summary, summary_compliance, inline_labels, text_by_category, section_coverage, entity_prf, entity_grounding, entity_present, gate_with_entities, entity_changed, rouge_l, json_repair, document_charsets)}

_LINES = f"SELECT emr_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM ({_RECORD})"
_HEAD = "CASE WHEN line = 'Жалобы:' THEN 'complaints' WHEN line = 'Общий анализ крови' THEN 'labs' WHEN line = 'Анамнез жизни' THEN 'history_life' WHEN line = 'Заключение' THEN 'conclusion' END"
_PLACED = f"SELECT *, count(head) OVER (PARTITION BY emr_id ORDER BY pos) AS ord FROM (SELECT *, {_HEAD} AS head FROM ({_LINES}))"
_SECTIONS = f"""SELECT emr_id, CAST(ord AS INT) AS ord, max(head) AS category, max(line) FILTER (head IS NOT NULL) AS title, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (head IS NULL AND line <> 'Осмотр кардиолога'), '') AS body,
any_value('10 апр ' || (2000 + CAST(emr_id AS BIGINT) % 25)) AS visit_date FROM ({_PLACED}) WHERE NOT regexp_matches(line, '^10 апр') GROUP BY emr_id, ord"""
_STYLES = """SELECT k, unnest(CASE k % 5
WHEN 0 THEN [(1, 'complaints', 'Жалобы', 'боль ' || k), (2, 'history_illness', 'Анамнез заболевания', 'давно'), (3, 'other', 'Прочее', 'разное')]
WHEN 1 THEN [(0, NULL, NULL, 'Вступление'), (1, 'complaints', 'Жалобы:', 'боль ' || k), (2, 'diagnosis', 'Диагноз:', 'инфаркт' || chr(10) || 'Боль: тупая')]
WHEN 2 THEN [(1, 'complaints', '1. Жалобы', 'боль ' || k), (2, 'history_life', '2) Анамнез жизни', 'курит'), (3, 'labs', '3. Лабораторные данные', 'Hb 120')]
WHEN 3 THEN [(1, 'complaints', 'Жалобы пациента', 'боль ' || k), (2, 'recommendations', 'Лечение', 'морфин' || chr(10) || 'Возраст: 60')]
ELSE [(1, 'labs', 'Лабораторные данные', 'Hb ' || k), (2, 'complaints', 'Жалобы.', 'нет')] END) AS s FROM (SELECT o_orderkey AS k FROM orders)"""
#: Which names the texts bear out, told from how the texts are made.
_BY_NAME = """SELECT *, CASE WHEN in_b > 0 THEN round((in_b - CAST(extra <> '' AS INT)) / in_b, 3) WHEN in_a = 0 THEN 1 ELSE 0 END::DOUBLE AS precision, round((in_a - n_missing) / in_a, 3)::DOUBLE AS recall,
round(CASE WHEN precision_ + (in_a - n_missing) / in_a > 0 THEN 2 * precision_ * ((in_a - n_missing) / in_a) / (precision_ + (in_a - n_missing) / in_a) ELSE 0 END::DOUBLE, 3) AS f1 FROM (SELECT *, CASE WHEN in_b > 0 THEN (in_b - CAST(extra <> '' AS INT)) / in_b ELSE 0 END AS precision_ FROM (
SELECT CAST(k AS STRING) AS emr_id, CASE WHEN k % 2 = 0 THEN 'radiologist' END AS scope, 0 AS ord, 'diagnoses' AS category, 1 AS in_a, CASE WHEN k % 11 = 0 THEN CASE WHEN k % 7 = 0 THEN 1 ELSE 2 END ELSE 1 END AS in_b, CASE WHEN k % 77 = 0 THEN 0 ELSE 1 END AS matched, CASE WHEN k % 77 = 0 THEN 'инфаркт миокарда.' ELSE '' END AS missing, CASE WHEN k % 11 = 0 THEN 'пневмония' ELSE '' END AS extra, CASE WHEN k % 77 = 0 THEN 1 ELSE 0 END AS n_missing FROM (SELECT o_orderkey AS k FROM orders) UNION ALL
SELECT CAST(k AS STRING), CASE WHEN k % 2 = 0 THEN 'radiologist' END, 1, 'medications', 2, CASE WHEN k % 4 = 0 OR k % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN k % 4 = 0 OR k % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN k % 4 = 0 THEN 'Морфин,определение аспирина' ELSE 'определение аспирина' END, '', CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END FROM (SELECT o_orderkey AS k FROM orders) UNION ALL
SELECT CAST(k AS STRING), CASE WHEN k % 2 = 0 THEN 'radiologist' END, 4, 'symptoms', 1, 0, 0, 'одышка', '', 1 FROM (SELECT o_orderkey AS k FROM orders)))"""
ORACLE_SQL = {
    "document_charsets": """SELECT doc_id, CASE WHEN doc_id % 3 = 1 AND text <> '' THEN 'UTF-16LE' WHEN doc_id % 3 = 2 AND regexp_full_match(text, '(?s)[\\x{0}-\\x{7F}\\x{A0}-\\x{FF}]*') AND NOT regexp_full_match(text, '(?s)[\\x{0}-\\x{7F}]*') THEN 'windows-1252' WHEN text IS NOT NULL THEN 'UTF-8' END AS charset,
        md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5 FROM documents""",
    "segment_source": _SECTIONS,
    "schema_compliance": f"""SELECT emr_id, CASE WHEN k % 3 = 2 THEN 'complaints' ELSE 'complaints,history_life,labs' END AS present, CASE WHEN k % 3 = 2 THEN 'history_illness,history_life,labs,instrumental' ELSE 'history_illness,instrumental' END AS missing,
        k % 3 > 0 AS in_order, k % 3 < 2 AS complete FROM (SELECT emr_id, CAST(emr_id AS BIGINT) AS k FROM ({_RECORD}))""",
    "section_coverage": f"SELECT s.category, CAST(s.ord AS INT) AS schema_ord, count(t.category) AS n, coalesce(CAST(sum(length(body)) AS BIGINT), 0) AS n_chars FROM (VALUES " + ", ".join(f"('{c}', {k})" for k, c in enumerate(lx.SCHEMA_SECTIONS)) + f") s(category, ord) LEFT JOIN ({_SECTIONS}) t ON s.category = t.category GROUP BY ALL",
    "segment_summary": f"SELECT CAST(k AS STRING) AS emr_id, s[1] AS ord, s[2] AS category, s[3] AS title, s[4] AS body FROM ({_STYLES})",
    "summary_compliance": """SELECT CAST(k AS STRING) AS emr_id, CASE k % 5 WHEN 0 THEN 'complaints,history_illness' WHEN 2 THEN 'complaints,history_life,labs' WHEN 4 THEN 'complaints,labs' ELSE 'complaints' END AS present,
        CASE k % 5 WHEN 0 THEN 'history_life,labs,instrumental' WHEN 2 THEN 'history_illness,instrumental' WHEN 4 THEN 'history_illness,history_life,instrumental' ELSE 'history_illness,history_life,labs,instrumental' END AS missing,
        k % 5 < 4 AS in_order, k % 5 = 2 AS complete FROM (SELECT o_orderkey AS k FROM orders)""",
    "inline_labels": """SELECT CAST(k AS STRING) AS emr_id, s[1] AS ord, s[2] AS category, s[3] AS title, s[4] AS body FROM (SELECT k, unnest([(0, NULL, NULL, 'Пациент ' || k || ' поступил.'), (1, 'complaints', 'Жалобы', 'боли в сердце, одышка. Цвет – обычный.'),
        (2, 'history_life', 'Вредные привычки', 'курит ' || (k % 40) || ' лет.'), (3, 'labs', 'Общий анализ крови', 'гемоглобин 115 г/л.')]) AS s FROM (SELECT o_orderkey AS k FROM orders))""",
    "text_by_category": f"SELECT emr_id, category, string_agg(body, chr(10) || chr(10) ORDER BY ord) AS text FROM ({_SECTIONS}) WHERE ord > 0 AND body <> '' GROUP BY ALL",
    "entity_prf": """SELECT emr_id, category, in_a, in_b, matched, round(p, 3) AS precision, round(r, 3) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END::DOUBLE, 3) AS f1 FROM (
        SELECT *, CASE WHEN in_b > 0 THEN matched / in_b WHEN in_a = 0 THEN 1 ELSE 0 END::DOUBLE AS p, CASE WHEN in_a > 0 THEN matched / in_a ELSE 1 END::DOUBLE AS r FROM (
        SELECT CAST(o_orderkey AS STRING) AS emr_id, 'diagnoses' AS category, 2 AS in_a, CASE WHEN o_orderkey % 4 = 1 THEN 2 ELSE 1 END AS in_b, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS matched FROM orders UNION ALL
        SELECT CAST(o_orderkey AS STRING), 'medications', 1, CAST(o_orderkey % 5 > 0 AS INT), CAST(o_orderkey % 5 > 0 AS INT) FROM orders UNION ALL
        SELECT CAST(o_orderkey AS STRING), unnest(['procedures', 'departments', 'symptoms', 'anamnesis']), 0, 0, 0 FROM orders))""",
    "entity_grounding": f"SELECT emr_id, category, in_a, in_b, matched, missing, extra, precision, recall, f1 FROM ({_BY_NAME})",
    "entity_present": """WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM conversations),
        n AS (SELECT t.conv_id, t.turn, array_to_string(b.w[:2], ' ') AS name, t.w, list_filter(b.w[:2], lambda x: length(x) >= 3) AS long, b.w[:2] AS own FROM t JOIN t b ON b.conv_id = t.conv_id AND b.turn + 1 = t.turn)
        SELECT conv_id, turn, name, len(asked) > 0 AND coalesce(list_bool_and(list_transform(asked, lambda x: coalesce(list_bool_or(list_transform(w, lambda y: length(x) >= 3 AND length(y) >= 3 AND least(length(x), length(y)) >= greatest(3, least(length(x), length(y)) - 2)
          AND x[:greatest(3, least(length(x), length(y)) - 2)] = y[:greatest(3, least(length(x), length(y)) - 2)])), false))), false) AS present FROM (SELECT *, CASE WHEN len(long) > 0 THEN long ELSE own END AS asked FROM n)""",
    "gate_with_entities": f"""SELECT emr_id, any_value(scope) AS scope, CASE WHEN bool_or(severity = 'reject') THEN 'reject' WHEN count(code) > 0 THEN 'rework' ELSE 'pass' END AS gate_status, coalesce(string_agg(code, ',' ORDER BY ord) FILTER (code IS NOT NULL), '') AS codes FROM (
        SELECT *, CASE WHEN in_a = 0 THEN NULL WHEN scope IS NULL AND recall = 0 AND category IN ('diagnoses', 'medications') THEN 'entity_recall_zero:' || category WHEN scope IS NOT NULL AND recall < 0.5 THEN 'entity_recall_low:' || category END AS code,
        CASE WHEN recall = 0 THEN 'reject' ELSE 'rework' END AS sev, CASE WHEN code IS NOT NULL THEN sev END AS severity FROM ({_BY_NAME})) GROUP BY emr_id""",
    "entity_changed": f"SELECT emr_id, bool_or(missing <> '' OR extra <> '') AS changed FROM ({_BY_NAME}) GROUP BY emr_id",
    "json_repair": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
}
