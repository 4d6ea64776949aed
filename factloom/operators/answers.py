"""Model answers that should be JSON: read by a scanner that forgives, and typed by a schema.

The scanner is a state machine over the text with a stack of open containers.
It runs in Arrow batches, since no built-in function goes on after an error; it
gives back strict JSON, which Spark then reads by the schema.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SPACE = re.compile(r"\s*")
_NAME = re.compile(r"[^\W\d][\w$-]*")
_NUMBER = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?![\w.])")
_WORD = re.compile(r"[^\s,:{}\[\]]+")
_LITERALS = {"true": True, "false": False, "null": None, "none": None, "nan": None, "infinity": None, "undefined": None}
_AFTER_THOUGHT = re.compile(r".*?</think>", re.DOTALL)
_FENCE = re.compile(r"```(?:[A-Za-z]+)?")
#: What is told apart outside of strings by _plain: bare keys, commas too many, Python's literals; and values that are numbers, which it leaves alone.
_BARE, _MORE, _VALUE = re.compile(r"([{,]\s*)([^\W\d]\w*)(?=\s*:)"), re.compile(r",(?=\s*[}\]])"), re.compile(r"[:\[,]\s*[-+.\d]")
_PYTHON = [(re.compile(f"(?<=[:\\[,\\s]){word}(?=\\s*[,}}\\]])"), told) for word, told in (("True", "true"), ("False", "false"), ("None", "null"))]
_ENDS = {quote: re.compile(f"[{quote}\\\\]") for quote in "\"'"}
#: Containers within each other that are read; what lies deeper is left out.
DEPTH = 100
_STRICT = json.JSONDecoder(parse_constant=lambda _: None)


class _Cut(Exception):
    """The text ends within a key or a value."""


def _past_space(text: str, at: int) -> int:
    """Where the next character that is no white space stands, from at on; of runs only the first is not left to the pattern."""
    return at if at < len(text) and not text[at].isspace() else _SPACE.match(text, at).end()


def _string(text: str, at: int, key: bool) -> tuple[str, int]:
    """The string that begins with the quote at at, and where it ends.

    A quote ends a value only before a comma, a bracket, the end or a further
    string, and ends a key at once; so a quote within prose stays in it.
    """
    quote, out, size = text[at], [], len(text)
    at += 1
    while m := _ENDS[quote].search(text, at):
        out.append(text[at : m.start()])
        at = m.start()
        c = text[at]
        if c == "\\":
            if at + 1 >= size:
                break
            if text[at + 1] == "u" and re.match(r"[0-9a-fA-F]{4}", text[at + 2 : at + 6]):
                out.append(chr(int(text[at + 2 : at + 6], 16)))
                at += 6
            else:
                out.append({"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}.get(text[at + 1], text[at + 1]))
                at += 2
            continue
        after = _past_space(text, at + 1)
        if key or after >= size or text[after] in ",}]" or text[after] in "\"'" and after > at + 1:
            return "".join(out), at + 1
        out.append(c)
        at += 1
    raise _Cut


def _scalar(text: str, at: int) -> tuple[object, int] | None:
    """A quoted string, number or literal that begins at at; None for any other word."""
    if text[at] in "\"'":
        return _string(text, at, False)
    if m := _NUMBER.match(text, at):
        number = m[0].lstrip("+")
        whole = re.fullmatch(r"-?\d{1,300}", number)
        value = int(number) if whole else float(number)
        return (value if whole or abs(value) < float("inf") else None), m.end()
    word = _WORD.match(text, at)
    if word and word[0].lower() in _LITERALS:
        return _LITERALS[word[0].lower()], word.end()
    if word and word.end() == len(text):
        raise _Cut
    return None


def _scan(text: str, at: int) -> tuple[dict, int]:
    """The object whose brace is at at, and where reading stopped.

    Fields with a broken value are left out and the rest is read on. Where the
    text ends between two elements, open containers are closed; where it ends
    within one, the field of the outermost object that holds it is left out.
    """
    root: dict = {}
    stack: list[dict | list] = [root]
    names: list[str | None] = [None]
    at, size = at + 1, len(text)
    try:
        while True:
            at = _past_space(text, at)
            if at >= size:
                if names[-1] is not None:
                    raise _Cut
                return root, at
            top, c = stack[-1], text[at]
            if c in "}]":
                kind = dict if c == "}" else list
                places = [k for k, x in enumerate(stack) if isinstance(x, kind)]
                if places:
                    del stack[places[-1] :], names[places[-1] :]
                    if not stack:
                        return root, at + 1
                    names[-1] = None
                at += 1
            elif c == ",":
                names[-1] = None
                at += 1
            elif isinstance(top, dict) and names[-1] is None:
                if c in "{[" and len(stack) == 1 and not root:
                    return root, at  # prose before: the object begins here
                m = _NAME.match(text, at)
                if c in "\"'":
                    name, at = _string(text, at, True)
                elif m:
                    name, at = m[0], m.end()
                else:
                    at += 1
                    continue
                after = _past_space(text, at)
                if after >= size:
                    raise _Cut
                if text[after] == ":":
                    names[-1], at = name, after + 1
                elif c in "\"'" and text[after] not in ",}]":
                    names[-1] = name  # the colon is missing
            elif c in "{[":
                if len(stack) >= DEPTH:
                    at, names[-1] = _skipped(text, at), None
                    continue
                inner: dict | list = {} if c == "{" else []
                _put(top, names[-1], inner)
                stack.append(inner)
                names.append(None)
                at += 1
            else:
                found = _scalar(text, at)
                if found is None:
                    at = _WORD.match(text, at).end() if _WORD.match(text, at) else at + 1
                else:
                    _put(top, names[-1], found[0])
                    at = found[1]
                names[-1] = None
    except _Cut:
        if names[0] is not None:
            root.pop(names[0], None)
        return root, size


def _plain(text: str, at: int) -> dict | None:
    """What _scan finds from at on, for the commonest faults, told without a loop over the text: bare keys, commas too many and Python's literals in what else is strict JSON without numbers; None where more is needed."""
    own = text[at:]
    parts = own.split('"')
    outside = "\0".join(parts[::2])
    opened = outside.count("{")
    if not len(parts) % 2 or opened != outside.count("}") or opened + outside.count("[") > DEPTH or "\\" in own or "'" in own or "\0" in own or _VALUE.search(outside):
        return None
    outside = _MORE.sub("", _BARE.sub('\\1"\\2"', outside))
    for pattern, told in _PYTHON:
        outside = pattern.sub(told, outside)
    pieces = outside.split("\0")
    try:
        return _STRICT.raw_decode("".join(x for pair in zip(pieces, [f'"{p}"' for p in parts[1::2]] + [""]) for x in pair))[0]
    except (ValueError, RecursionError):
        return None


def _skipped(text: str, at: int) -> int:
    """Behind the container that begins at at, by its brackets alone."""
    depth = 0
    for m in re.compile(r"[{\[\]}]").finditer(text, at):
        depth += 1 if m[0] in "{[" else -1
        if not depth:
            return m.end()
    return len(text)


def _put(top: dict | list, name: str | None, value: object) -> None:
    if isinstance(top, list):
        top.append(value)
    else:
        top[name] = value


def read(raw: str | None) -> dict | None:
    """The first object with fields in an answer, without thoughts and code fences; None where there is none.

    Strict JSON is read as it is. Else single quotes, bare keys, other
    languages' literals, missing colons and commas, commas too many, unbalanced
    brackets and raw line ends are forgiven, and an answer that breaks off keeps
    the fields that came whole. Of keys that repeat the last one counts.
    """
    text = raw or ""
    if "</think>" in text:
        text = text[_AFTER_THOUGHT.match(text).end() :]
    if "```" in text:
        text = _FENCE.sub("", text)
    at = text.find("{")
    empty, tried = None, False
    while at >= 0:
        try:
            found, end = _STRICT.raw_decode(text, at)
        except (ValueError, RecursionError):
            # once: it reads the whole rest of the text
            if not tried and (found := _plain(text, at)):
                return found
            tried = True
            found, end = _scan(text, at)
        if found:
            return found
        empty = {} if text[at + 1 : end].strip() == "}" else empty
        at = text.find("{", end)
    return empty


@F.arrow_udf(StringType())
def strict(answers: pa.Array) -> pa.Array:
    """Each answer's object as strict JSON, else null."""

    def dumped(raw: str | None) -> str | None:
        found = read(raw)
        try:
            return None if found is None else json.dumps(found)
        except RecursionError:  # strict JSON that is nested deeper than Python can write
            return json.dumps(_scan(raw, raw.find("{"))[0])

    return pa.array([dumped(a) for a in answers.to_pylist()], pa.string())


def parsed(answers: DataFrame, column: str, schema: str) -> DataFrame:
    """answers with parsed: the answer's object by the schema (see read); null where there is none. Fields of another type are null."""
    return answers.withColumn("parsed", F.from_json(strict(F.col(column).cast("string")), schema, {"mode": "PERMISSIVE"}))


def salvage(answer: Column) -> Column:
    """The answer's object as a variant, whose fields need no schema; null where there is none."""
    return F.try_parse_json(strict(answer))
