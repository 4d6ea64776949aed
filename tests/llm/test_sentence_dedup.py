"""Repeated passages are covered up to their last sentence."""

import random
from collections import defaultdict

import pytest

from factloom.llm import sentence_dedup


def passage(lengths, name):
    return [" ".join(f"{name}{k}x{i}" for i in range(n)) + "." for k, n in enumerate(lengths)]


@pytest.mark.parametrize("lengths", [(12, 9, 8, 7), (25, 3, 4), (5, 5, 5, 5, 5), (3, 4, 25), (40, 19), (51,)])
@pytest.mark.parametrize("after", [[], [4, 30]])
def test_no_tail_of_a_repeated_passage_stays(spark, lengths, after):
    same = passage(lengths, "same")
    rows = [(k, " ".join([*passage((6, 15), f"before{k}"), *same, *passage(after, f"after{k}")])) for k in (1, 2)]
    got = sentence_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text, r.n_removed, r.first_doc_ids) for r in got] == [(2, " ".join(passage((6, 15), "before2") + passage(after, "after2")), len(lengths), [1])]


def test_spans_from_and_up_to_each_sentence():
    text = " ".join(passage((12, 9, 8, 15), "w"))
    assert [s[:2] for s in sentence_dedup.spans(text, sentence_dedup.sentences(text))] == [(0, 2), (0, 3), (1, 4), (2, 4)]
    assert [s[:2] for s in sentence_dedup.spans(" ".join(passage((25, 39, 40), "w")), [(0, 100), (101, 300), (301, 600)])][-1:] == [(2, 3)]
    assert sentence_dedup.spans("too short.", [(0, 10)]) == sentence_dedup.spans("", []) == []


def plain_removal(rows):
    """Sentences that a run shares with a run of an earlier document, or with an earlier run of its own; runs are compared as texts."""
    at = {d: [t[s:e] for s, e in sentence_dedup.sentences(t)] for d, t in rows}
    enough = lambda run: len(run) >= 2 and sum(len(x.split()) for x in run) >= 20 or len(run) == 1 and len(run[0].split()) >= 40
    seen, gone = {}, defaultdict(set)
    for d in sorted(at):
        own = set()
        for i in range(len(at[d])):
            for j in range(i + 1, len(at[d]) + 1):
                run = at[d][i:j]
                # shortest at its begin or its end
                if enough(run) and (j - i == 1 or not enough(run[:-1]) or not enough(run[1:])):
                    key = tuple(" ".join(x.lower().split()) for x in run)
                    if key in seen or key in own:
                        gone[d] |= set(range(i, j))
                    own.add(key)
        for key in own:
            seen.setdefault(key, d)
    return {d: len(s) for d, s in gone.items()}


def test_same_sentences_go_as_in_a_comparison_of_all_runs(spark):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(n)) + "." for n in (2, 5, 7, 9, 12, 15, 22, 41) for _ in range(2)]
    rows = [(d, rng.choice([" ", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for d in range(60)]
    got = {r.doc_id: r.n_removed for r in sentence_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_removal(rows) and got


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b. " * 30, 1), (4, " ".join(passage((30, 30), "same")), 1), (4, " ".join(passage((30, 30), "same")), 1)], "doc_id long, text string, h long")
    assert sentence_dedup.deduplicate(frame).count() == 0 == sentence_dedup.deduplicate(frame.limit(0)).count()
