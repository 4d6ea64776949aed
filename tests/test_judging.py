"""Judges' tasks and answers: broken ones, silent judges, retries, reviews, the aggregator, and texts."""

import json

import pytest

from factloom import lexicons as lx
from factloom.operators import judging, votes

ANSWER = "emr_id string, model_id string, round int, role string, block string, attempt int, raw string"
ROLES = ("x", "y", "z")


def full(block, **changed):
    body = {c: {"pass": True, "comment": "ok"} for c in judging.CODES[block]}
    return body | changed


def answer(block, body, role="x", attempt=1, emr="1", round_=1):
    return (emr, "m", round_, role, block, attempt, body if body is None or isinstance(body, str) else json.dumps(body))


def first(spark, *rows):
    return judging.block_answers(spark.createDataFrame(list(rows), ANSWER))


@pytest.fixture(scope="module")
def asked(spark):
    return judging.tasks(spark.createDataFrame([("1", "m", "pass"), ("2", "m", "reject"), ("3", "m", None), ("4", None, "rework")], "emr_id string, model_id string, gate_status string"), ROLES)


def test_tasks_of_pairs_that_the_gate_lets_through(asked):
    rows = asked.collect()
    assert {r.emr_id for r in rows} == {"1", "4"} and len(rows) == 2 * 3 * 5
    for pair in ("1", "4"):
        assert sorted({(r.role, r.place) for r in rows if r.emr_id == pair}, key=lambda t: t[1])[-1][1] == 3


def test_the_order_of_judges_follows_the_seed_alone(spark):
    gated = spark.createDataFrame([(str(k), "m", "pass") for k in range(300)], "emr_id string, model_id string, gate_status string")
    leads = lambda seed: {r.emr_id: r.role for r in judging.tasks(gated, ROLES, seed).where("place = 1").collect()}
    one = leads(1)
    assert one == leads(1) != leads(2)
    assert all(60 <= list(one.values()).count(r) <= 140 for r in ROLES)


@pytest.mark.parametrize(
    ("raw", "error"),
    [
        (full("C"), None),
        ("<think>{}</think>```json\n" + json.dumps(full("C"))[:-1] + ",}```", None),
        (full("C", C2={"pass": "true"}), "no boolean pass: C2"),
        (full("C", C1=True), "no boolean pass: C1"),
        (full("C", C1={"pass": 1}, C2={"comment": ""}), "no boolean pass: C1, C2"),
        (json.dumps(full("C"))[:-30], "no boolean pass: C2"),
        ("I can't judge that", "no object"),
        ("", "no object"),
        (None, "no answer"),
    ],
)
def test_only_booleans_are_votes(spark, raw, error):
    (row,) = first(spark, answer("C", raw)).collect()
    assert (row.valid, row.error) == (error is None, error)


def test_one_broken_block_leaves_the_others(spark, asked):
    rows = [answer(b, full(b) if b != "C" else "broken", role) for role in ROLES for b in lx.BLOCKS]
    told = judging.first_votes(asked.where("emr_id = '1'"), first(spark, *rows))
    assert told.count() == 3 * 16
    assert {(r.block, r["pass"], r.error) for r in told.collect()} == {(b, None if b == "C" else True, "no object" if b == "C" else None) for b in lx.BLOCKS}
    labels = {r.block: r.label for r in votes.blocks(votes.criteria(votes.final_votes(told))).collect()}
    assert labels["A"] == "3/3" and labels["C"] == lx.NO_DATA


def test_a_judge_who_fails_alone_changes_no_majority(spark, asked):
    told = judging.first_votes(asked.where("emr_id = '1'"), first(spark, answer("A", "broken", "x"), answer("A", full("A"), "y"), answer("A", full("A"), "z")))
    assert {r.block: r.label for r in votes.blocks(votes.criteria(votes.final_votes(told))).collect()}["A"] == "3/3"


def test_the_first_valid_attempt_counts_and_the_rest_is_asked_again(spark, asked):
    no = full("D", D1={"pass": False, "comment": "late"})
    found = first(spark, answer("D", "no", attempt=1), answer("D", full("D"), attempt=2), answer("D", no, attempt=3), *(answer("E", "no", attempt=k) for k in range(1, 5)), answer("B", None, attempt=2))
    told = {r.block: r for r in found.collect()}
    assert told["D"].valid and all(c["pass"] for c in told["D"].criteria) and not told["E"].valid
    again = {(r.block, r.attempt, r.short) for r in judging.pending(asked.where("emr_id = '1' AND role = 'x'"), found).collect()}
    assert again == {("A", 1, False), ("B", 3, True), ("C", 1, False)}  # D is done, E has used its attempts


def test_null_ids_repeats_clashing_columns_and_no_answers(spark, asked):
    rows = [(None, None, 1, None, "A", 1, "{}"), (None, None, 1, "x", None, 1, "{}"), (None, None, 1, "x", "Q", 1, "{}"), ("4", None, 1, "x", "A", None, json.dumps(full("A")))]
    odd = spark.createDataFrame([(*r, "extra") for r in rows * 2], ANSWER + ", parsed string")
    found = judging.block_answers(odd.drop("parsed"))
    assert [(r.emr_id, r.model_id, r.block, r.valid) for r in found.collect()] == [("4", None, "A", True)]
    told = judging.first_votes(asked.where("emr_id = '4' AND role = 'x' AND block = 'A'"), found)
    assert [r["pass"] for r in told.collect()] == [True] * 3
    none = first(spark, *rows).limit(0)
    assert judging.pending(asked, none).count() == asked.count()
    assert {r.error for r in judging.first_votes(asked, none).collect()} == {judging.NO_ANSWER}
    assert judging.reviews(none).count() == 0


def test_a_review_takes_what_is_valid_and_leaves_the_rest(spark, asked):
    rows = [answer(b, full(b)) for b in lx.BLOCKS]
    revised = {"A": {"A1": {"pass": False, "comment": "seen"}, "A2": {"pass": "no"}}, "E": "nothing"}
    told = judging.first_votes(asked.where("emr_id = '1' AND role = 'x'"), first(spark, *rows)).unionByName(judging.revised_votes(spark.createDataFrame([answer(None, revised, round_=2), answer(None, "broken", "y", round_=2)], ANSWER)))
    kept = {(r.role, r.code): r["pass"] for r in votes.final_votes(told).collect()}
    assert not kept["x", "A1"] and all(kept["x", c] for codes in judging.CODES.values() for c in codes if c != "A1")
    assert all(v is None for (role, _), v in kept.items() if role == "y")
    assert {r.code: r.comment for r in judging.counting(told).where("role = 'x'").collect()}["A1"] == "seen"


def test_reviews_show_two_others(spark):
    alone = [answer("A", full("A"), emr="7")]
    pair = [answer("A", full("A", A1={"pass": False, "comment": role}), role, emr="8") for role in ("x", "y")]
    panel = [answer("A", full("A", hallucinations=[f"h-{role}", {"a": 1}]), role, emr="9") for role in ROLES]
    rows = {(r.emr_id, r.role): r for r in judging.reviews(first(spark, *alone, *pair, *panel)).collect()}
    assert rows["7", "x"].peers == [rows["7", "x"].own] * 2
    assert rows["8", "x"].peers == [rows["8", "y"].own] * 2
    for role in ROLES:
        assert sorted(rows["9", role].peers) == sorted(rows["9", r].own for r in ROLES if r != role) and f"h-{role}" in rows["9", role].own
        assert json.loads(rows["9", role].own)["A"]["listed"][1] == '{"a":1}'
    assert sorted(rows["9", r].place for r in ROLES) == [1, 2, 3]


def test_the_aggregator_is_validated(spark):
    good = {"category": lx.EDIT, "e1_triggered": True, "e1_triggered_by": ["x", None], "verdict": "v"}
    cases = {"1": (good, None), "2": (good | {"category": "so so"}, "no category"), "3": (good | {"e1_triggered": "yes"}, "no boolean e1_triggered"), "4": ("prose", "no object"), "5": (None, "no answer")}
    rows = [answer(None, body, None, emr=k, round_=3) for k, (body, _) in cases.items()] + [answer(None, good, None, 2, "4", 3)]
    found = {r.emr_id: r for r in judging.aggregates(spark.createDataFrame(rows, ANSWER)).collect()}
    assert {k: r.error for k, r in found.items()} == {k: e if k != "4" else None for k, (_, e) in cases.items()}
    assert (found["1"].flagged, found["1"].named, found["1"].llm_category) == (True, ["x"], lx.EDIT)
    assert (found["2"].flagged, found["2"].named, found["2"].llm_category) == (False, [], None)


def test_stop_signals_and_their_texts(spark, asked):
    danger = full("E", E1={"pass": False, "comment": "dose", "danger_examples": ["ten times", "twice"]})
    told = judging.first_votes(asked.where("emr_id = '1'"), first(spark, answer("E", danger, "y"), answer("E", full("E", E1={"pass": False}), "x"), answer("E", full("E"), "z")))
    final, counted = votes.final_votes(told), judging.counting(told)
    voices = spark.createDataFrame([("1", "m", False, ["z"]), ("2", "m", False, [])], "emr_id string, model_id string, flagged boolean, named array<string>")
    seen = {r.emr_id: (r.raised_by, r.consistent) for r in judging.stop_consistency(final, voices).collect()}
    assert seen == {"1": (["x", "y"], False), "2": ([], True)}
    assert judging.dangers(counted).first().examples == "x:  | y: dose [ten times; twice]"
    assert [(r.block, r.comments) for r in judging.comments(counted, votes.criteria(final)).collect()] == [("E", "E1/y: dose")]


def test_verdicts_in_words(spark, asked):
    gates = spark.createDataFrame([("1", "m", "pass"), ("2", "m", "reject"), ("3", "m", "pass"), ("5", "m", "pass")], "emr_id string, model_id string, gate_status string")
    rows = [answer(b, full(b, C1={"pass": False}) if b == "C" else full(b)) for b in "ABCD"] + [answer(b, full(b), emr="5") for b in lx.BLOCKS]
    told = judging.first_votes(judging.tasks(gates, ["x"]), first(spark, *rows))
    final = votes.final_votes(told)
    reasons = spark.createDataFrame([("2", "m", ["a", "b"])], "emr_id string, model_id string, reasons array<string>")
    said = {r.emr_id: r.verdict for r in judging.verdicts(votes.decide(gates, final), votes.blocks(votes.criteria(final)), reasons).collect()}
    assert said["1"] == lx.VERDICT_ISSUES % (lx.EDIT, lx.ISSUE_FAILED % ("C", "C1") + "; " + lx.ISSUE_OPEN % ("E", "E1, E2, E3"))
    assert said["2"] == lx.VERDICT_GATE % "a, b" and said["5"] == lx.VERDICT_CLEAN % lx.READY
    assert said["3"].startswith(f"«{lx.REJECT}»") and all(lx.ISSUE_OPEN % (b, ", ".join(c)) in said["3"] for b, c in judging.CODES.items())


def test_tasks_meet_their_answers_by_pair(spark, tmp_path):
    """Repeated pairs, null ids and silent judges give the same tasks either way, and no table of tasks is sent to every executor."""
    gated = spark.createDataFrame([("1", "m", "pass"), ("1", "m", "rework"), ("2", "m", "reject"), ("4", None, "pass")], "emr_id string, model_id string, gate_status string")
    rows = [answer("A", full("A"), attempt=2), answer("A", "no", attempt=1), answer("B", "no", "y"), ("4", None, 1, "z", "C", 3, None), answer("A", "no", emr="2"), answer("A", "no", emr="9")]
    told = first(spark, *rows)
    both = [judging.pending_of(judging.asked(gated, ROLES, told)), judging.pending(judging.tasks(gated, ROLES), told)]
    one, other = (sorted(map(str, rows.collect())) for rows in both)
    assert one == other and len(one) == 2 * 14 + 15
    short = judging.block_answers(spark.createDataFrame(rows, ANSWER), valid_only=True)
    assert sorted(map(str, short.collect())) == sorted(map(str, told.select(short.columns).collect()))
    votes_ = [judging.votes_of(judging.asked(gated, ROLES, told)), judging.first_votes(judging.tasks(gated, ROLES), told)]
    assert sorted(map(str, votes_[0].collect())) == sorted(map(str, votes_[1].collect()))
    gated.write.parquet(f"{tmp_path}/gated")
    spark.createDataFrame(rows, ANSWER).write.parquet(f"{tmp_path}/answers")
    small = judging.block_answers(spark.read.parquet(f"{tmp_path}/answers"))
    plan = judging.pending(judging.tasks(spark.read.parquet(f"{tmp_path}/gated"), ROLES), small).where("short")
    assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_panels_say_what_the_rows_say_with_one_shuffle(spark):
    """Ties, null ids and attempts, repeated pairs, silent and broken judges, comments that are no text."""
    gated = spark.createDataFrame([("1", "m", "pass"), ("1", "m", "rework"), ("2", "m", "reject"), ("4", None, "pass"), ("5", "m", "pass")], "emr_id string, model_id string, gate_status string")
    no = lambda comment: full("A", A2={"pass": False, "comment": comment})
    rows = [answer("A", no("b"), attempt=2), answer("A", no("a"), attempt=2), answer("A", "no", attempt=1), answer("A", no(3), "y"), answer("B", "no", "y", 1), answer("B", None, "y", 3), answer("C", full("C"), "z")]
    rows += [("4", None, 1, "z", "A", None, json.dumps(no("n"))), ("4", None, 1, "z", "A", 1, json.dumps(full("A"))), answer("A", no("x"), emr="2"), answer("A", no("x"), "other", emr="5"), answer("A", no(""), emr="5"), ("5", "m", 2, "x", "A", 1, "{}"), ("5", "m", 1, None, "A", 1, "{}")]
    given = spark.createDataFrame(rows, ANSWER)
    panels = judging.panels(gated, ROLES, given)
    told = judging.counting(judging.votes_of(judging.asked(gated, ROLES, judging.block_answers(given))))
    want = judging.comments(told, votes.criteria(told))
    found = judging.panel_comments(panels, ROLES)
    # the rows' join drops pairs with a null id, panels keep them
    assert sorted(map(str, found.where("model_id IS NOT NULL").collect())) == sorted(map(str, want.select(found.columns).collect()))
    assert {(r.emr_id, r.comments) for r in found.collect()} == {("1", "A2/x: a; A2/y: 3"), ("4", "A2/z: n")}
    best = {(r.emr_id, t.role, t.block): (t.attempts, t.error) for r in panels.collect() for t in r.told}
    assert best == {(r.emr_id, r.role, r.block): (r.attempts, r.error) for r in judging.block_answers(given).where("emr_id <> '2' AND role <> 'other'").collect()}
    assert [r.n for r in panels.where("emr_id = '1'").collect()] == [2]
    assert found.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
