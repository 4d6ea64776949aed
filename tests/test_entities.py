"""Names told apart in Arrow batches are those that the column expressions on single names tell."""

import random
import re

from pyspark.sql import functions as F

from factloom import lexicons as lx
from factloom.operators import entities
from factloom.plans import texts

PIECES = ["инфаркт", "инфаркта", "Миокарда", "миакарда", "ИБС", "a1", "дексаметазон", "дексаметазна", "-", "острый", "диагноз", " ", "\x1f", " ", ".", "боль;"]


def test_single_names_as_columns_tell_them(spark):
    draw = random.Random(5)
    name = lambda: "".join(draw.choice(PIECES) + draw.choice([" ", " ", "", "\t"]) for _ in range(draw.randint(0, 4)))
    rows = [(name(), name(), name()) for _ in range(600)]
    frame = spark.createDataFrame(rows, "a string, b string, text string")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"({lx.TOKEN})")))
    seen = entities.matches(frame.select("a", "b", "text")).withColumns({"normal": entities.normal(F.col("a")), "there": entities.present(entities.normal(F.col("a")), tokens)}).collect()
    got = [(r.a, r.b, r.text, entities._alike(entities._normal(r.a), entities._normal(r.b)), entities._normal(r.a), entities._Text(r.text).has(entities._normal(r.a))) for r in seen]
    assert got == [(r.a, r.b, r.text, r.match, r.normal, r.there) for r in seen]
    assert 0 < sum(r.match for r in seen) < 600 and 0 < sum(r.there for r in seen) < 600


def test_null_names_maps_and_texts(spark):
    rows = spark.createDataFrame([(1, {"diagnoses": ["инфаркт", None, "инфаркт"]}, {"diagnoses": ["Инфаркт.", None]}, None), (2, None, {"symptoms": None}, "боль"), (3, {"symptoms": ["боль", None]}, {}, "боль")], "k int, entities_a map<string,array<string>>, entities_b map<string,array<string>>, t string")
    found = {r.k: {e["category"]: e for e in r.entities} for r in entities.compared(rows, "t", "t").collect()}
    one = found[1]["diagnoses"]
    assert (one.in_a, one.in_b, one.matched, one.missing, one.extra) == (3, 2, 1, ["инфаркт"], [])
    assert all((e.in_a, e.in_b, e.precision, e.recall) == (0, 0, 1.0, 1.0) for e in found[2].values())
    assert (found[3]["symptoms"].in_a, found[3]["symptoms"].missing) == (1, [])


def test_names_are_compared_in_one_call(spark):
    plan = texts.entity_changed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("told(") == plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan


def test_words_are_found_the_same_when_many_are_asked():
    """a text is searched as it is for the first words asked, and by its own words in order for further ones."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("абв1 ") for _ in range(draw.randint(1, 7)))
    text = " ".join(word() for _ in range(80)) + "-абваб"
    names = [word() for _ in range(3 * entities._LOOKED_FOR)]
    tokens = re.findall(lx.TOKEN, text)
    alike = lambda t, x: len(t) >= 3 <= len(x) and t[: max(3, min(len(t), len(x)) - 2)] == x[: max(3, min(len(t), len(x)) - 2)] and min(len(t), len(x)) >= max(3, min(len(t), len(x)) - 2)
    plain = [bool(entities._asked(n)) and all(any(alike(t, x) for x in tokens) for t in entities._asked(n)) for n in names]
    own = entities._Text(text)
    assert [own.has(n) for n in names] == plain and own.by_stem and 0 < sum(plain) < len(plain)
