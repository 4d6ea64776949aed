"""Overlaps with benchmark items against a plain search of all runs."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import decontamination


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5).map(bool), min_size=1, max_size=40))
def test_longest_run_with_a_fifth_substituted(equal):
    n = len(equal)
    alike = [(j - i, -i) for i in range(n) for j in range(i + 1, n + 1) if 5 * sum(equal[i:j]) >= 4 * (j - i)]
    start, end = decontamination.best_overlap(np.array(equal))
    assert (end - start, -start) == max(alike) if alike else start == end


def found(spark, size, substituted):
    item = [f"item{i}" for i in range(size)]
    text = ["before", "it", *("other" if i in substituted else t for i, t in enumerate(item)), "after", "it"]
    documents = spark.createDataFrame([(1, " ".join(text)), (2, "nothing of it")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = decontamination.leaks(documents, benchmark).collect()
    assert decontamination.drop_leaks(documents, benchmark).count() == 2 - len(rows)
    return [(r.doc_id, r.item_id, r.doc_start, r.item_start, r.n_tokens, r.n_equal) for r in rows]


@pytest.mark.parametrize("size, substituted", [(13, {0}), (13, {11}), (16, {3}), (16, {2, 13}), (18, {1, 16}), (24, {4, 9, 14, 19})])
def test_substitutions_at_edges_and_evenly_spaced(spark, size, substituted):
    assert found(spark, size, substituted) == [(1, 7, 2, 0, size, size - len(substituted))]


def test_more_than_a_fifth_is_no_overlap(spark):
    assert found(spark, 13, {0, 1, 12}) == []


@pytest.mark.parametrize("size", [5, 6, 7, 8, 9, 12])
def test_short_items_with_one_substitution_anywhere(spark, size):
    item = [f"item{i}" for i in range(size)]
    rows = [(k, " ".join(["before", "it", *("other" if i == k else t for i, t in enumerate(item)), "after"])) for k in range(size)]
    got = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert sorted((r.doc_id, r.n_equal) for r in got.collect()) == [(k, size - 1) for k in range(size)]


def test_items_of_few_tokens_are_whole_documents(spark):
    documents = spark.createDataFrame([(1, "Forty two!"), (2, "it is forty two"), (3, "forty")], "doc_id long, text string")
    got = decontamination.leaks(documents, spark.createDataFrame([(7, "forty two")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.n_tokens) for r in got] == [(1, 7, 2)]


def plain_overlap(text, item):
    """The best run of any diagonal that has a seed, by looking at all runs."""
    masks = decontamination.masks_for([len(item)])
    best = None
    for shift in range(-len(item) + 1, len(text)):
        low, high = max(shift, 0), min(shift + len(item), len(text))
        equal = [text[i] == item[i - shift] for i in range(low, high)]
        if not any(all(equal[i + j] for j in m) for m in masks for i in range(len(equal) - m[-1])):
            continue
        runs = [(j - i, -i) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1) if 5 * sum(equal[i:j]) >= 4 * (j - i)]
        n, start = max(runs)
        if n >= min(13, len(item)):
            row = (-sum(equal[-start : -start + n]), n, low - start, low - start - shift)
            best = row if best is None else min(best, row)
    return None if best is None else (-best[0], *best[1:])


def test_overlaps_equal_those_of_all_diagonals():
    rng = np.random.default_rng(2)
    hits = 0
    for _ in range(150):
        item = rng.integers(0, 40, rng.integers(5, 30)).astype(np.uint64)
        text = rng.integers(0, 40, rng.integers(0, 60)).astype(np.uint64)
        if len(text) > 8:
            at = rng.integers(0, len(text) - 5)
            text[at : at + len(item)] = item[: len(text) - at]
            text[rng.integers(0, len(text), 3)] = 99
        got = decontamination.overlap(text, item, decontamination.masks_for([len(item)]))
        assert got == plain_overlap(text.tolist(), item.tolist())
        hits += got is not None
    assert hits > 30


def test_one_repeated_word_is_cheap(spark):
    documents = spark.createDataFrame([(1, "same " * 20_000), (2, "same " * 5)], "doc_id long, text string")
    got = decontamination.leaks(documents, spark.createDataFrame([(7, "same " * 300), (8, "same " * 20)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_start, r.n_equal) for r in got) == [(1, 7, 0, 300), (1, 8, 0, 20)]


def test_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(15))
    documents = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, item, 1), (3, item, 1), (3, item, 1), (4, "other words", 1)], "doc_id long, text string, row long")
    benchmark = spark.createDataFrame([(7, item), (7, item), (7, item + " more"), (None, item), (8, None), (9, "")], "item_id long, text string")
    assert sorted(((r.doc_id or 0, r.item_id, r.n_equal) for r in decontamination.leaks(documents, benchmark).collect())) == [(0, 7, 15), (3, 7, 15), (3, 7, 15)]
    kept = decontamination.drop_leaks(documents, benchmark)
    assert kept.columns == documents.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert decontamination.leaks(documents.limit(0), benchmark).count() == decontamination.leaks(documents, benchmark.limit(0)).count() == 0
    assert decontamination.drop_leaks(documents, benchmark.limit(0)).count() == 6
