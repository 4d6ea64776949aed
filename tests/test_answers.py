"""The forgiving scanner: known answers, strict JSON as it is, and every place at which an answer may break off."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.operators import answers

KNOWN = [
    ('```json\n{"A1": {"pass": true, "comment": "ok"}}\n```', {"A1": {"pass": True, "comment": "ok"}}),
    ('<think> weighing {this}... {"A1": {"pass": false}}', {"A1": {"pass": False}}),
    ('<think>{"no": 1}</think> {"A1": 2}', {"A1": 2}),
    ("{'A1': {'pass': True}, 'A2': {'pass': None},}", {"A1": {"pass": True}, "A2": {"pass": None}}),
    ('{"A1": {"pass": true, "comment": "x"}, "A2": {"pass": false}, "A3": {"pass": tr', {"A1": {"pass": True, "comment": "x"}, "A2": {"pass": False}}),
    ('{"A1": {"pass": true}, "A2": {"pass": false}, "A3": {"pass": zzz', {"A1": {"pass": True}, "A2": {"pass": False}}),
    ('{"k": 1, "r": "don\'t, won\'t"', {"k": 1, "r": "don't, won't"}),
    ('{"k": 1, "r": "don\'t, won\'t', {"k": 1}),
    ('prose {not json} then {"k": 9}', {"k": 9}),
    ('prose { then {"k": 9}', {"k": 9}),
    ('{"a" "x", "b": 2}', {"a": "x", "b": 2}),
    ('{"a": "x" "b": 2}', {"a": "x", "b": 2}),
    ('{a: 1,, b_2: [1, 2,], "c": .5}', {"a": 1, "b_2": [1, 2], "c": 0.5}),
    ('{"a": zzz, "b": {"c": yyy, "d": 1}}', {"b": {"d": 1}}),
    ('{"a": [1, 2}', {"a": [1, 2]}),
    ('{"a": 1}} tail {"b": 2}', {"a": 1}),
    ('{"q": "he said "no" twice", "n": -1e3}', {"q": 'he said "no" twice', "n": -1000.0}),
    ('{"line": "one\ntwo\\u00e9\\"", \'it\': \'don\'t\'}', {"line": 'one\ntwoé"', "it": "don't"}),
    ('{"a": NaN, "a": 3}', {"a": 3}),
    ("{}", {}), ("", None), (None, None), ("no braces", None), ("{", None), ("}{", None),
]


@pytest.mark.parametrize("raw,expected", KNOWN)
def test_known_answers(raw, expected):
    assert answers.read(raw) == expected


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-(10**9), 10**9) | st.text("ab'\"\\\n{}[],: é", max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("abc", min_size=1, max_size=3), x, max_size=3), max_leaves=8)
OBJECTS = st.dictionaries(st.text("abcd", min_size=1, max_size=3), VALUES, min_size=1, max_size=4)


@settings(max_examples=300, deadline=None)
@given(OBJECTS)
def test_strict_and_scanned_alike(found):
    text = json.dumps(found)
    assert answers.read("Answer: " + text) == found
    assert answers._scan(text, 0)[0] == found


@settings(max_examples=300, deadline=None)
@given(OBJECTS, st.data())
def test_broken_off_anywhere(found, data):
    """Fields that came whole before the break are kept; others are whole containers, cut between elements, or left out."""
    text = json.dumps(found)
    at = data.draw(st.integers(0, len(text)))
    kept = answers.read(text[:at]) or {}
    whole, end = {}, 1
    for key, value in found.items():
        end += len(json.dumps({key: value})) - 2
        if end < at:
            whole[key] = value
        end += 2
    assert {k: kept[k] for k in whole} == whole
    assert set(kept) <= set(found)


def test_many_braces_take_linear_time():
    assert answers.read("{ " * 200_000) is None
    assert answers.read("{" * 200_000) is None
    assert answers.read('{"a":' * 5_000 + "1") is not None


def test_typed_by_a_schema(spark):
    rows = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(KNOWN)], "id int, raw string")
    out = answers.parsed(rows, "raw", "k bigint, a string").orderBy("id").select("parsed").collect()
    assert [r.parsed.k if r.parsed else None for r in out] == [e.get("k") if e else None for _, e in KNOWN]
    assert rows.where("id = 0").select(F.try_variant_get(answers.salvage(F.col("raw")), "$.A1.comment", "string")).first()[0] == "ok"
    assert answers.parsed(rows.limit(0), "raw", "k bigint").count() == 0


def test_common_faults_are_told_without_the_scanner_and_alike():
    chance = random.Random(7)
    good = '{"A1": {"pass": true, "comment": "part: {1}, a, b"}, "A2": {"pass": False, "list": ["x", None, "y",], }, c: {pass: True,},}'
    pieces = ['"', "'", ",", ":", "{", "}", "[", "]", " ", "\n", "True", "a", "1", "\\", "None", "nOne", ",,", " "]
    told = 0
    for k in range(6000):
        text = good
        for _ in range(k % 4):
            at = chance.randrange(len(text))
            text = text[:at] + chance.choice([*pieces, ""]) + text[at + chance.randrange(3) :]
        for tried in (text, text + " and so on"):
            at = tried.find("{")
            if at >= 0 and (plain := answers._plain(tried, at)):
                try:
                    answers._STRICT.raw_decode(tried, at)
                except ValueError:
                    told += 1
                    assert plain == answers._scan(tried, at)[0], tried
    assert told > 1000
