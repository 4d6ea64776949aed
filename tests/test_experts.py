"""Experts' files with other headings, and how automatic marks agree with them."""

import math
import random

import pytest

from factloom import lexicons as lx
from factloom.operators import agreement
from factloom.sources import experts

FILES = {
    "a": "case_id,category,score,note\n1,Неприемлемо,3,x\n2, Требует редактирования ,,\n",
    "b": "Карта;Категория эксперта;Итоговая оценка (балл)\n3;Готово к клиническому применению;1,5\n4;;2\n",
    "c": "Файл,Обоснование,Балл_эксперта\n5,\"two\nlines, quoted\",7\n,nobody,1\n6,none,many\n",
    "d": "ID,Verdict\n7,Неприемлемо\n8\n9,x,y\n",
    "e": "Комментарий,Идентификатор карты,Класс\nok,10,Неприемлемо\n",
}


def test_five_headings_give_one_table(spark, tmp_path):
    paths = []
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        paths.append(str(tmp_path / f"{name}.csv"))
    rows = {r.case_id: r for r in experts.read_experts(spark, paths).collect()}
    assert set(rows) == {str(k) for k in range(1, 11)}
    assert (rows["1"].score, rows["2"].category, rows["3"].score, rows["4"].category) == (3.0, lx.EDIT, 1.5, None)
    assert rows["5"].note == "two\nlines, quoted" and rows["10"].category == lx.REJECT
    assert {k for k, r in rows.items() if r.bad is not None} == {"6", "8", "9"}
    (tmp_path / "f.csv").write_text("case_id,nothing\n1,2\n")
    with pytest.raises(ValueError, match="f.csv"):
        experts.read_experts(spark, [str(tmp_path / "f.csv")])


def test_report(spark):
    """Eight matched cases, one alone on each side; the last row of a case counts."""
    marks = [("1", lx.READY, lx.READY), ("2", lx.EDIT, lx.EDIT), ("3", lx.REJECT, lx.REJECT), ("4", lx.READY, lx.EDIT), ("5", lx.EDIT, lx.REJECT), ("6", lx.REJECT, lx.REJECT), ("7", lx.READY, lx.READY), ("8", lx.EDIT, lx.EDIT)]
    schema = "case_id string, category string, score double, order long"
    auto = spark.createDataFrame([("3", lx.READY, None, 0)] + [(c, a, None, 1) for c, a, _ in marks] + [("9", lx.READY, None, 1), (None, lx.READY, None, 1)], schema)
    expert = spark.createDataFrame([(c, e, None, 1) for c, _, e in marks] + [("1", lx.REJECT, None, 0), ("10", lx.READY, None, 1)], schema)
    r = agreement.correlate(auto, expert).first()
    assert (r.n_matched, r.unmatched_auto, r.unmatched_expert, r.n_spearman) == (8, 1, 1, 8)
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.accuracy) == (2, 0, 1, 5, 1.0, 0.875)
    assert 0.5 < r.rho < 1 and 0 < r.p < 0.1


def test_known_p_values(spark):
    """Student's t with 1 and 2 degrees has closed forms; with many it nears the normal distribution."""
    rows = [(0.5, 3), (-0.5, 4), (0.3, 4), (0.0, 10), (1.0, 5), (None, 5), (0.01, 40_000)]
    found = [r.p for r in spark.createDataFrame(rows, "rho double, n long").coalesce(1).select(agreement.p_value("rho", "n").alias("p")).collect()]
    t = 0.5 * math.sqrt(1 / 0.75)
    assert abs(found[0] - (1 - 2 / math.pi * math.atan(t))) < 1e-12
    assert abs(found[1] - 0.5) < 1e-12 and abs(found[2] - 0.7) < 1e-12
    assert found[3] == 1 and found[4] == 0 and found[5] is None
    assert abs(found[6] - math.erfc(0.01 * math.sqrt(39_998 / (1 - 1e-4)) / math.sqrt(2))) < 1e-5


def test_average_ranks_over_ranges(spark):
    rng = random.Random(1)
    own = [rng.choice([rng.gauss(0, 1), 0.5, -3.0]) for _ in range(3000)] + [None]
    order = sorted(x for x in own if x is not None)
    first, last = {}, {}
    for k, x in enumerate(order, 1):
        first.setdefault(x, k)
        last[x] = k
    found = agreement.average_ranks(spark.createDataFrame([(x,) for x in own], "x double"), "x").collect()
    assert len(found) == 3000 and all(r.x_rank == (first[r.x] + last[r.x]) / 2 for r in found)
    assert agreement.spearman(spark.createDataFrame([], "x double, y double"), "x", "y").first()["rho"] is None
