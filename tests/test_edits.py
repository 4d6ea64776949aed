"""Edit scripts: known answers, and scripts that rebuild the second text from the first."""

import random

import pytest

from factloom.operators import edits
from factloom.sources import matrix

KNOWN = [
    ("число", "Пациент 56 лет.", "Пациент 46 лет."),
    ("отрицание", "Тест положительный.", "Тест не положительный."),
    ("опечатка", "Пациентка госпитализирована.", "Пациентка госпиталлизирована."),
    ("перестановка", "слабость, одышку и боль", "одышку, слабость и боль"),
    ("перестановка", "то же самое", "То же самое."),
    ("перестановка", "боль и жар", "боль — и жар"),
    ("вставка", "жалоб много", "жалоб сегодня очень уж много"),
    ("вставка", "жалоб сегодня очень уж много", "жалоб много"),
    ("лексическая_замена", "сильная боль", "резкая боль"),
    ("лексическая_замена", "боль", "боль острая"),
    ("опечатка", "стенокардия покоя", "стенокардея покоя"),
    ("лексическая_замена", "рана чиста", "рана части"),
]


@pytest.mark.parametrize("kind,a,b", KNOWN)
def test_known_answers(kind, a, b):
    assert edits.script(a, b)[1] == [kind]


def test_scripts_rebuild_the_second_text(spark):
    rng = random.Random(5)
    words = ["не", "без", "5", "10мг", "боль", "Боль,", "—", "инфаркт", "инфаркта", "the", "a", "."]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(0, 25))), " ".join(rng.choices(words, k=rng.randrange(0, 25)))) for k in range(200)] + [(900, None, "x"), (901, "", None), (902, None, None)]
    out = edits.with_edits(spark.createDataFrame(rows, "id int, a string, b string"), "a", "b").collect()
    assert len(out) == len(rows)
    for r in out:
        a, b = (r.a or "").split(), (r.b or "").split()
        built, at = [], 0
        for e in r.edits:
            assert e.a_from >= at and (e.a_to > e.a_from or e.b_to > e.b_from)
            built += [edits.plain(w) for w in a[at : e.a_from]] + [edits.plain(w) for w in b[e.b_from : e.b_to]]
            at = e.a_to
        built += [edits.plain(w) for w in a[at:]]
        assert built == [edits.plain(w) for w in b]
        assert r.n_equal == len(a) - sum(e.a_to - e.a_from for e in r.edits)
        assert set(r.kinds) == ({e.kind for e in r.edits} or {edits.ORDER})


def test_matrix(spark):
    rows = [(k, f" source {c}\n" if k == 0 else f"text {c} of 5" if k == 1 else f"text {c} of {k}" if k < 38 else "  ") for k in range(41) for c in "x"]
    wide = spark.createDataFrame([(k, t, t if k != 1 else None, t if k else " ") for k, t in rows], "label int, p string, q string, r string")
    found = matrix.pairs(wide, "label").collect()
    assert {r.case_name for r in found} == {"p"}
    assert sorted(r.row_no for r in found) == list(range(2, 38))
    assert {(r.pair_id, r.dtype, r.severity, r.reference, r.candidate) for r in found if r.row_no == 12} == {("p#row12", "искажение_числа", "critical", "text x of 5", "text x of 12")}
    assert matrix.pairs(wide.limit(0), "label").count() == 0
    warned = {r.row_no: r.warned for r in edits.legend_warnings(matrix.pairs(wide, "label")).collect()}
    assert warned[5] is False and warned[20] is True
