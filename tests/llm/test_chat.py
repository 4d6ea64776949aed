"""Speaker markers, and conversations of any shape in bounded chunks."""

import pytest

from factloom.llm import chat


@pytest.mark.parametrize("mark", ["### Assistant", "# Assistant ", "**Assistant**", "<|im_start|>assistant", "<|assistant|>", "<assistant>", "[assistant]", "Assistant:", "**Assistant:**", "### Response:", "### Response"])
def test_marker_opens_a_turn(mark):
    units = chat.units_of(None, f"Hello?\n{mark}\nGood day\nto you")
    assert [(u[2], body.strip()) for u, body in units] == [(None, "Hello?"), (2, "Good day\nto you")]


@pytest.mark.parametrize("line", ["assistant", "### Assistant editors wanted", "**User** interfaces", "<|im_start|>assistant x", "#usernames"])
def test_no_marker(line):
    assert chat.marker(line) == (None, line)


@pytest.mark.parametrize("end", ["<|im_end|>\n", "\n<|im_end|>\n", "<|im_end|>"])
def test_chatml_row(end):
    row = "".join(f"<|im_start|>{name}\n{text}{end}" for name, text in (("system", "Be brief."), ("user", "Why?"), ("assistant", "So.")))
    assert [(u[2], body.strip()) for u, body in chat.units_of(None, row)] == [(0, "Be brief."), (1, "Why?"), (2, "So.")]


@pytest.mark.parametrize("turns", ["none", "one", "rising"])
def test_chunks_are_bounded_and_exact(spark, monkeypatch, turns):
    turn = {"none": lambda k: None, "one": lambda k: 7, "rising": lambda k: k}[turns]
    rows = [(None if c == 0 else c, turn(k), None if k % 3 else "user", f"{'Why' if k % 2 else 'Since'} {k:04}{'?' if k % 2 else ''}") for c in (0, 1) for k in range(600)]
    frame = spark.createDataFrame(rows + [(2, 0, "user", "Hi"), (2, 1, None, "Hello")], "conv_id long, turn long, role string, text string")
    sizes = [r["count"] for r in chat._chunked(frame).groupBy("conv_id", "chunk").count().collect()]
    assert max(sizes) <= chat.CHUNK and sum(sizes) == 1202
    got = sorted(map(tuple, chat.format_chats(frame).collect()), key=repr)
    monkeypatch.setattr(chat, "CHUNK", 10**6)
    assert got == sorted(map(tuple, chat.format_chats(frame).collect()), key=repr) and len(got) == 1202


def test_best_path_equals_that_of_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(4)
    model = chat.Model(rng.integers(0, 9, 3), rng.integers(0, 9, (3, 3)), rng.integers(0, 9, (3, 2 * chat._FEATURES)))
    for _ in range(40):
        units = [(bool(rng.integers(2)) or not k, *(None if rng.integers(2) else int(rng.integers(3)) for _ in range(2)), int(rng.integers(2 * chat._FEATURES))) for k in range(rng.integers(1, 7))]
        steps = model.steps(units)

        def total(path):
            return model.before[3] + sum(step[a, b] for step, a, b in zip(steps, (3, *path), path))

        got = chat.viterbi(model.before, steps, None)
        assert abs(total(tuple(got)) - max(total(p) for p in itertools.product(range(3), repeat=len(units)))) < 1e-9


def test_first_role_and_order_outweigh_a_wrong_role(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], "Why is that so?" if t % 2 == 0 else "Because of this and that. " * 9) for c in range(60) for t in range(4)]
    rows[41 * 4 + 1] = (41, 1, "user", rows[1][3])
    got = {(r.conv_id, r.turn): r.role for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[41, 1] == "assistant" and got[41, 0] == "user" and got[7, 1] == "assistant"


def test_lines_of_one_role_are_one_turn(spark):
    frame = spark.createDataFrame([(1, 0, None, "User: one\nUser: two\nAssistant: three")], "conv_id long, turn long, role string, text string")
    assert [(r.role, r.text) for r in chat.format_chats(frame).orderBy("part").collect()] == [("user", "one\ntwo"), ("assistant", "three")]
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_markers_stay_unless_the_path_has_their_role(spark):
    talk = [(c, t, ("user", "assistant")[t % 2], "Why is that so?" if t % 2 == 0 else "Because of this and that. " * 9) for c in range(60) for t in range(4)]
    camera, sure, asked = "Model: X5 camera\nCustomer: John Smith\nContext: shop", "Hello there?\n### Assistant\nGood day to you", "Q: Why?\nA: So it is."
    talk += [(100, 0, "user", camera), (101, 0, "user", sure), (102, 0, None, asked), (103, 0, "user", "A: first\nB: second?"), (104, 0, "assistant", "User: Why?")]
    got: dict = {}
    for r in chat.format_chats(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).where("conv_id >= 100").orderBy("conv_id", "turn", "part").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got[100] == [("user", camera)] and got[103] == [("user", "A: first\nB: second?")]
    assert got[101] == [("user", "Hello there?"), ("assistant", "Good day to you")]
    assert got[102] == [("user", "Why?"), ("assistant", "So it is.")]
    assert got[104] == [("user", "Why?")]


def test_no_character_is_lost_but_markers():
    import numpy as np

    rng = np.random.default_rng(5)
    model = chat.Model(rng.integers(0, 9, 3), rng.integers(0, 9, (3, 3)), rng.integers(0, 9, (3, 2 * chat._FEATURES)))
    lines = ["Model: 11", "plain", "### User", "A: 22", "Assistant: 33", "", "[human] 44", "Context: 55?"]
    for _ in range(60):
        text = "\n".join(rng.choice(lines, rng.integers(1, 9)))
        row, units = {}, chat.units_of(rng.choice(["user", "assistant", ""]), text)
        assert "\n".join(u.cut + body for u, body in units) == text
        roles = chat.viterbi(model.before, model.steps([u for u, _ in units]), None)
        turns = list(chat._merged([(row, k, u, body) for k, (u, body) in enumerate(units)], roles))
        left = "\n".join(t[3] for t in turns)
        assert all(left.count(word) == text.count(word) for word in ("11", "plain", "22", "33", "44", "55?"))
        assert all(a[2] != b[2] for a, b in zip(turns, turns[1:]))
