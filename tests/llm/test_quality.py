"""Repetition coverage against a plain reading of its rules."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    owner = [[tuple(words[i : i + n]) for i in range(len(words) - n + 1)] for n in range(11)]

    def inside(n, starts):
        return {p for i in starts for p in range(i, i + n)}

    seen3 = Counter(owner[3])
    chars = {}
    for n in quality.MAX_NGRAM_COVERAGE:
        seen, later = set(), []
        for i, w in enumerate(owner[n]):
            if w in seen:
                later.append(i)
            seen.add(w)
        chars[n] = sum(len(words[p]) for p in inside(n, later))
    lines, dup, dup_chars, n_lines = set(), 0, 0, 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own:
            n_lines += 1
            if line in lines:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, own))
            lines.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_repeat_words": len(inside(3, [i for i, w in enumerate(owner[3]) if seen3[w] > 1])),
        "ngram_chars": list(chars.values()),
        "n_lines": n_lines,
        "n_dup_lines": dup,
        "dup_line_chars": dup_chars,
    }


def check(texts):
    found = quality.measure(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {k: v[i].tolist() for k, v in found.items()} == plain(text), text


TEXT = st.lists(st.sampled_from(["a", "b", "é", "a b c d e f", " ", "\n", "\t", "\x0b", "\x1c", " ", "#", "<", "a b\n"]), max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_counts_equal_the_plain_ones(texts):
    check(texts)


def test_odd_texts():
    check(["", " ", "\n\n", "a", "a a a a a a a a a a a a", "x y z\nx y z\nx y z", " lead and trail ", "w " * 3000])


def test_verdicts(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    loop = "one two three four five six seven " * 20
    half = clean + " " + " ".join(f"word{i}" for i in range(40))
    rows = [(1, clean, "x"), (2, loop, "x"), (3, "short", "x"), (4, None, "x"), (5, "", "x"), (6, half, "x"), (6, half, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.judge(frame).collect())
    assert got == [(1, 80, False, True), (2, 140, True, False), (3, 1, True, False), (4, 0, True, False), (5, 0, True, False), (6, 120, True, False), (6, 120, True, False)]
    assert quality.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", quality.MAX_NGRAM_COVERAGE)
def test_covered_positions(n):
    import numpy as np

    for size in range(0, 2 * n + 3):
        for starts in ([], [0], [0, 2]):
            starts = [s for s in starts if s + n <= size]
            want = [any(s <= p < s + n for s in starts) for p in range(size)]
            assert quality.covered(np.array(starts, dtype=np.int64), n, size).tolist() == want
