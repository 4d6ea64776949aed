"""Known answers of the operators, and empty and null input."""

import random

from pyspark.sql import functions as F

from factloom.functions.text import lcs
from factloom.operators import answers, drift, entities, segment, votes
from factloom.operators.compare import compare

PAIRS = "emr_id string, model_id string, source_text string, summary_text string"


def objective(spark, a, b):
    return compare(spark.createDataFrame([("1", "m", a, b)], PAIRS)).select("objective").first()[0]


def test_claims_and_causes(spark):
    rows = [("АД снижено (150/90 мм рт. ст.)", 1), ("гемоглобин повышен (115 г/л)", 1), ("ЧСС снижена (86 в минуту)", 1), ("гемоглобин снижен (115 г/л)", 0), ("АД повышено (174/98 мм рт. ст.)", 0), ("КФК в норме (126 ед/л)", 0)]
    found = compare(spark.createDataFrame([(str(k), "m", "", t) for k, (t, _) in enumerate(rows)], PAIRS)).select("emr_id", "objective.interpretation.count").collect()
    assert {int(k): n for k, n in found} == {k: n for k, (_, n) in enumerate(rows)}
    assert objective(spark, "инфаркт миокарда и курение", "инфаркт миокарда вследствие курения")["causality"]["introduced"] == 1


def test_null_and_empty_texts_have_no_facts(spark):
    found = objective(spark, None, "")
    assert (found["numeric"]["total_in_a"], found["polarity"]["total_in_a"], found["causality"]["in_b"]) == (0, 0, 0)
    assert compare(spark.createDataFrame([], PAIRS)).count() == 0


def test_same_value_in_another_unit(spark):
    found = objective(spark, "боль 40 минут", "боль 40 часов")["numeric"]
    assert (found["matched"], found["mismatch_count"], found["unit_mismatch_count"]) == (1, 0, 1)


def test_entity_matches(spark):
    rows = [("госпитализирована", "госпиталлизирована", True), ("инфаркт", "инфаркт миокарда", True), ("кфк (креатинфосфокиназа)", "кфк", True), ("кардиореанимация", "нейрореанимация", False), ("слабость", "головокружение", False)]
    found = entities.matches(spark.createDataFrame([r[:2] for r in rows], "a string, b string")).collect()
    assert {(r["a"], r["b"]): r["match"] for r in found} == {r[:2]: r[2] for r in rows}


def test_lcs_equals_the_table(spark):
    def table(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    rng = random.Random(7)
    cases = [([rng.choice("abc") for _ in range(rng.randrange(9))], [rng.choice("abc") for _ in range(rng.randrange(9))]) for _ in range(60)]
    found = spark.createDataFrame(cases, "a array<string>, b array<string>").select("a", "b", lcs("a", "b").alias("n")).collect()
    assert all(r["n"] == table(r["a"], r["b"]) for r in found)


def test_broken_answers(spark):
    rows = [('```json\n{"k": 1}\n```', 1), ("{'k': 2,}", 2), ('<think>x</think>{"k": 3', 3), ("no braces", None)]
    found = answers.parsed(spark.createDataFrame([(r[0],) for r in rows], "answer string"), "answer", "k long").select("answer", F.col("parsed.k")).collect()
    assert dict(found) == dict(rows)


def test_grounding_omission_and_invention(spark):
    def told(a, b, ea, eb):
        rows = spark.createDataFrame([(a, b, ea, eb)], "a string, b string, entities_a map<string,array<string>>, entities_b map<string,array<string>>")
        return {e["category"]: e for e in entities.compared(rows, "a", "b").first()["entities"]}

    assert told("назначен морфин", "назначен морфином внутривенно", {"medications": ["морфин"]}, {})["medications"]["missing"] == []
    assert told("назначен морфин", "терапия скорректирована", {"medications": ["морфин"]}, None)["medications"]["missing"] == ["морфин"]
    assert told("боль за грудиной", "боль за грудиной", {"symptoms": ["тошнота"]}, {})["symptoms"]["in_a"] == 0
    rows = spark.createDataFrame([("определение гемоглобина", "гемоглобин 115 г/л", True), ("тошнота", "приступ загрудинных болей", False)], "name string, text string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", entities.present(F.col("name"), F.split("text", " ")).alias("got")).collect())


def test_a_silent_second_round_leaves_the_first_standing(spark):
    rows = [("1", "m", 1, role, "A", "A1", True) for role in ("x", "y", "z")] + [("1", "m", 2, "x", "A", "A1", None), ("1", "m", 2, "y", "A", "A1", False), ("1", "m", 1, "x", "A", "A2", None)]
    frame = spark.createDataFrame(rows, "emr_id string, model_id string, round int, role string, block string, code string, pass boolean")
    final = {(r.role, r.code): (r["pass"], r["round"]) for r in votes.final_votes(frame).collect()}
    assert final == {("x", "A1"): (True, 1), ("y", "A1"): (False, 2), ("z", "A1"): (True, 1), ("x", "A2"): (None, None)}
    block = votes.blocks(votes.criteria(votes.final_votes(frame))).first()
    assert (block["label"], block["score"], block["status"], block["undetermined"]) == ("1/2 (н/д:1)", 100.0, "issues", ["A2"])


def test_missing_text_has_no_hash(spark):
    got = drift.audit_rows(spark.createDataFrame([("1", "m", None, "")], PAIRS), F.lit("r")).first()
    assert got.source_hash is None and got.summary_hash.startswith("e3b0c442")


def test_odd_summaries(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "## "), (4, "**Жалобы**\n\n"), (5, "Боль: тупая")], "k int, text string")
    got = sorted((r.k, r.ord, r.category, r.body) for r in segment.summary_sections(rows, "k").collect())
    assert got == [(2, 0, None, ""), (3, 1, "other", ""), (4, 1, "complaints", ""), (5, 0, None, "Боль: тупая")]
