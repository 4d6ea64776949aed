"""The whole report of a pair: known findings, entities on and off, signals counted."""

import random

import pyarrow as pa
import pytest

from factloom import lexicons as lx
from factloom.functions.text import fold
from factloom.operators import facts, report, suspects
from factloom.plans import facts as plans

from .test_compare import texts

SOURCE = "Пациент, 40 лет, поступил. Гемоглобин 100 г/л. Приступ болей купирован. Назначен морфин 5 мг."
SUMMARY = "Пациент, 40 лет, поступил. Гемоглобин 110 г/л. Приступ болей не купирован вследствие лечения. АД снижено (150/90 мм рт. ст.)."
PAIR = "id int, source_text string, summary_text string"
NAMES = ", entities_a map<string,array<string>>, entities_b map<string,array<string>>"


def test_findings_are_told_in_order(spark):
    row = report.objective_report(spark.createDataFrame([(1, SOURCE, SUMMARY, {"medications": ["морфин"]}, {"medications": []})], PAIR + NAMES)).first()
    assert [f.kind for f in row.findings] == ["number", "polarity", "causality", "interpretation", "entity"]
    told = [f.told for f in row.findings]
    assert told[0] == "число «100 г/л» -> «110 г/л» (контекст: …ациент, 40 лет, поступил. гемоглобин)".replace("ациент, 40 лет, поступил. гемоглобин", "пациент, 40 лет, поступил. гемоглобин"[-30:])
    assert told[1].startswith("полярность «купирован» -> «не купирован» (контекст: …")
    assert told[2] == "причинность: в кандидате введена связь, отсутствующая в референсе (вследствие)"
    assert told[3].startswith("ложная интерпретация: «снижено") and told[3].endswith("оценка «low» противоречит значению (норма: high)")
    assert told[4] == "medications: «морфин» не найдено в сравниваемом тексте"
    assert row.signals == ["numeric", "polarity", "entity", "causality", "interpretation"]


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "", {}, {}), (3, SOURCE, SOURCE, {"medications": [None, "морфин"]}, {"medications": ["Морфин"]}), (3, SOURCE, SOURCE, None, None)]
    frame = spark.createDataFrame(rows, PAIR + NAMES)
    got = report.objective_report(frame).orderBy("id").collect()
    assert [r.findings for r in got] == [[]] * 4 and [r.signals for r in got] == [[]] * 4
    plain = report.objective_report(spark.createDataFrame([(1, SOURCE, SUMMARY)], PAIR)).first()
    assert plain.entities is None and "entity" not in plain.signals and len(plain.findings) == 4
    assert report.objective_report(frame.limit(0)).count() == 0


def test_extra_entities_are_a_signal_but_no_finding(spark):
    row = report.objective_report(spark.createDataFrame([(1, "Боли.", "Боли. Пневмония.", {}, {"diagnoses": ["пневмония"]})], PAIR + NAMES)).first()
    assert row.findings == [] and row.signals == ["entity"]


def test_signals_are_counted_and_errors_found(spark):
    rows = [(1, "critical", "a", ["numeric", "entity"]), (2, "critical", "a", []), (3, "benign", "b", ["entity"]), (4, "benign", "b", []), (5, "benign", "b", [])]
    found = spark.createDataFrame(rows, "id int, severity string, dtype string, signals array<string>")
    got = {(r.severity, r.dtype): r for r in report.detection_summary(found, "dtype").collect()}
    assert (got["critical", "a"].rate, got["critical", "a"].rate_label, got["critical", "a"].n_entity, got["critical", "a"].n_numeric) == (0.5, "recall", 1, 1)
    assert (got["benign", None].rate, got["benign", None].rate_label) == (0.3333, "FPR") and got[None, None].n_flagged == 2
    assert {(r.id, r.kind) for r in report.detection_errors(found).collect()} == {(2, "miss"), (3, "false_alarm")}


def named(n, seed):
    """Pairs of texts with the patterns' words, and with names that are in them, elsewhere, odd or missing."""
    rng = random.Random(seed)
    pieces = ["боль", "Боли", "купирован", "пациентка", "гемоглобина", "АД", "г", "пневмония", "инфаркт миокарда", "инфаркт миакарда", "10 мг", ".", "", "определение гемоглобина", "исследование"]
    names = lambda: rng.choice([None, {}, {c: rng.choice([None, [], [rng.choice([*pieces, None]) for _ in range(rng.randint(1, 3))]]) for c in rng.sample([*lx.ENTITY_CATEGORIES, "прочее"], rng.randrange(4))}])
    return [(k, a, b, names(), names()) for k, (a, b) in enumerate(texts(n, seed))]


def test_alarms_are_those_of_the_whole_report(spark):
    """F1 F2 F3: what is found in whole batches, for suspect pairs alone, is what the comparison of every pair finds."""
    frame = spark.createDataFrame(named(3000, 4), PAIR + NAMES).repartition(3)
    for pairs in (frame, frame.drop("entities_a", "entities_b"), frame.limit(0)):
        told = lambda rows: sorted((r.id, str(r.findings), str(r.signals)) for r in rows.select("id", "findings", "signals").collect())
        assert told(report.alarms(pairs)) == told(report.objective_report(pairs))
    seen = {s for r in report.alarms(frame).select("signals").collect() for s in r.signals}
    assert seen == set(lx.SIGNALS)


def test_clauses_of_a_batch_are_those_of_its_texts():
    """also where a unit goes on after a full stop, where texts hold the mark of a clause's end, and in none."""
    rng = random.Random(6)
    odd = ["100/60 мм РТ. СТ.", "70 мм рт. ст", "мм Рт. ", "5 ед. ", "1. 5 мг", "10, 5 г", "\0", "не ", "купирован", ". ", ", ", "снижено 5 г/л", "вследствие", "патологии"]
    own = [None, "", *("".join(rng.choices(odd, k=rng.randrange(9))) for _ in range(2000))]
    for source in (own, own[:0]):
        read = suspects._Texts(pa.array(source, pa.string()), pa.array(source[::-1], pa.string()))
        assert [read.read(k) for k in range(2 * len(source))] == [(t or "", facts.read(t)) for t in (*source, *source[::-1])]
    for text in own[1:]:
        assert [(f.start, f.end) for f in facts.numbers(text)] == [m.span() for m in facts._UNIT.finditer(fold(text)[0])]
        assert all(f.label == facts.label(f.left(lx.LABEL_WINDOW)) for f in facts.numbers(text))


@pytest.mark.parametrize("name", ["hard_findings", "detection_by_signal", "detection_errors"])
def test_only_what_is_wrong_comes_back(spark, name):
    """F1 F2 F3: texts and names go to Python once, and no more than findings come back, without a shuffle of the pairs by id."""
    plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "wrong(" in plan and "lost(" in plan and "compared(" not in plan and "told(" not in plan
    assert name == "detection_by_signal" or "Aggregate" not in plan
