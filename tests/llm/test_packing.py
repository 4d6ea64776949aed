"""Packing: every id once, gapless sequences, the tokenizer's own ids, and best fit against a plain search."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from factloom.llm import packing
from factloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["Hello", "wörld", "a1b2", "тест", "don't", "x" * 30, "!!", "\n"]) for _ in range(rng.randrange(200)))) for k in range(200)]
    rows += [(500, None), (501, ""), (502, "  \n"), (503, "long " * 20_000), (None, "no id"), (504, "again"), (504, "again"), (2**53 + 1, "big id")]
    return rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()


def test_ids_are_the_tokenizers(packed):
    rows, pieces = packed
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = sorted((d if d is not None else -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows)
    wanted = sorted((d, s, n, zlib.crc32(struct.pack(f"<{n}I", *ids[s : s + n])), len(ids)) for d, ids in expected for s, n in packing.cut(len(ids)))
    assert sorted((p.doc_id if p.doc_id is not None else -1, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == wanted


def test_sequences_are_gapless_and_full(packed):
    own = defaultdict(list)
    for p in packed[1]:
        own[p.sequence_id].append((p.offset, p.length))
    for placed in own.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    total = sum(n for placed in own.values() for _, n in placed)
    assert len(own) <= -(-total // packing.WINDOW) + 2


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(8)
    for _ in range(60):
        lengths = sorted((rng.randrange(1, 65) for _ in range(rng.randrange(1, 60))), reverse=True)
        number, offset, fill = packing.best_fit(np.array(lengths), 64)
        used = []
        for need, n, at in zip(lengths, number.tolist(), offset.tolist()):
            rooms = [64 - u for u in used if 64 - u >= need]
            if rooms:
                assert 64 - used[n] == min(rooms) and at == used[n]
                used[n] += need
            else:
                assert n == len(used) and at == 0
                used.append(need)
        assert used == fill.tolist()


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
