"""Chat formatting: a hidden Markov model over markers and line features recovers roles, then turns are rendered."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

ROLES = ("system", "user", "assistant")
#: Rows of a conversation that are decoded in one piece at most.
CHUNK = 256
#: How a turn is rendered.
TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"

_NAMES = {"system": 0, "sys": 0, "developer": 0, "instruction": 0, "instructions": 0, "context": 0, "user": 1, "human": 1, "question": 1, "q": 1, "customer": 1, "client": 1, "prompter": 1, "me": 1, "assistant": 2, "ai": 2, "bot": 2, "answer": 2, "a": 2, "gpt": 2, "model": 2, "agent": 2, "chatbot": 2, "response": 2}
_MARKER = re.compile(r"^\s*(?:(?P<alone>#{1,6}\s*|\*{1,2}|<\|im_start\|>)|\[|<\|?)?(?:im_start\|>)?(?P<name>" + "|".join(sorted(_NAMES, key=len, reverse=True)) + r")(?:\*{1,2})?(?:\s*:\*{0,2}|\]\s*:?|\|?>\s*|(?(alone)(?=\s*$)|(?!)))\s*", re.IGNORECASE)
#: ChatML's end of a turn, where the line or the turn ends.
_END, _END_BEFORE = re.compile(r"<\|im_end\|>[^\S\n]*$", re.MULTILINE), re.compile(r"<\|im_end\|>[^\S\n]*(?=<\|im_start\|>)")
#: Names that open a line of ordinary text as well ("Model: X5", "Context: ..."): without brackets or signs around them they are weak markers.
_WEAK_NAMES = frozenset("sys developer instruction instructions context question q customer client me answer a model agent response".split())
#: How sure a marker in signs or brackets, a plain name with a colon, a weak one, and the role that a row declares, tell the speaker; a line without any keeps it. A declared role is one observation that others can outweigh.
_FRAMED, _PLAIN, _WEAK, _DECLARED, _STAY = 0.999, 0.99, 0.6, 0.9, 0.98
_LENGTHS = (20, 60, 120, 200, 400, 800, 1600)
_FEATURES = len(_LENGTHS) + 1


class Unit(NamedTuple):
    """A piece of a row up to the next line that looks like a marker; cut is that marker as written."""

    opens: bool
    declared: int | None
    marked: int | None
    feature: int | None
    sure: float = _FRAMED
    cut: str = ""


def _read(line: str) -> tuple[int | None, float, str]:
    """The role that a line's opening marker names, how sure it is, and the marker as written."""
    m = _MARKER.match(line)
    if not m:
        return None, _FRAMED, ""
    name, framed = m["name"].lower(), bool(line[: m.start("name")].strip())
    return _NAMES[name], _FRAMED if framed else _WEAK if name in _WEAK_NAMES else _PLAIN, m[0]


def marker(line: str) -> tuple[int | None, str]:
    """The role that a line's opening marker names, and the line without it."""
    role, _, written = _read(line)
    return role, line[len(written) :]


def _feature(length: int, asks: bool) -> int:
    return 2 * int(np.searchsorted(_LENGTHS, length, side="right")) + asks


class Model:
    """Log probabilities of first roles, of the next turn's role, and of a turn's features by role.

    The last state stands for the place before a conversation, from which first
    roles follow and which nothing leads to.
    """

    def __init__(self, starts: np.ndarray, moves: np.ndarray, features: np.ndarray):
        smooth = lambda x: np.log((x + 1) / (x + 1).sum(axis=-1, keepdims=True))
        n = len(ROLES)
        never = np.full((n + 1, 1), -np.inf)
        start = smooth(starts)[None, :]
        # relative to all turns, so that a unit that opens a turn pays nothing for having features
        self.emit = smooth(features) - smooth(features.sum(axis=0))
        stay = np.log(np.where(np.eye(n, dtype=bool), _STAY, (1 - _STAY) / (n - 1)))
        self.move, self.stay = (np.hstack([np.vstack([m, start]), never]) for m in (smooth(moves), stay))
        self.before = np.array([-np.inf] * n + [0.0])

    def _declared(self, role: int | None) -> np.ndarray:
        return np.append(_told(role, _DECLARED), 0.0)

    def scores(self, unit: Unit) -> np.ndarray:
        """Of a unit that opens a turn, or of one without marker, under each role."""
        out = self.emit[:, unit.feature] if unit.feature is not None else np.zeros(len(ROLES))
        return np.append(out + _told(unit.marked, unit.sure), 0.0) + self._declared(unit.declared)

    def steps(self, units: list[Unit]) -> list[np.ndarray]:
        """From each state before a unit to each state of it.

        A unit that opens a row begins a turn. One that opens with a marker
        within a row begins a turn, or is text that goes on: the better of both.
        """
        out = []
        for unit in (Unit(*u) for u in units):
            step = (self.move if unit.opens or unit.marked is not None else self.stay) + self.scores(unit)[None, :]
            if unit.marked is not None and not unit.opens:
                goes_on = np.where(np.eye(len(self.before), dtype=bool), self.stay + np.log(1 - unit.sure), -np.inf)
                step = np.maximum(step, goes_on + self._declared(unit.declared)[None, :])
            out.append(step)
        return out


def _told(role: int | None, sure: float) -> np.ndarray:
    """Log probabilities of an observation that tells a role, under each role."""
    return np.zeros(len(ROLES)) if role is None else np.log(np.where(np.arange(len(ROLES)) == role, sure, (1 - sure) / (len(ROLES) - 1)))


def across(steps: list[np.ndarray]) -> np.ndarray:
    """The best path's score from each role before the steps to each role after them."""
    total = steps[0]
    for step in steps[1:]:
        total = (total[:, :, None] + step[None, :, :]).max(axis=1)
    return total


def viterbi(entry: np.ndarray, steps: list[np.ndarray], exit_role: int | None) -> list[int]:
    """The best roles: entry scores the roles before the first step, exit_role is the last one where it is known."""
    best, back = entry, []
    for step in steps:
        paths = best[:, None] + step
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0)
    role = int(best.argmax()) if exit_role is None else exit_role
    roles = []
    for came in reversed(back):
        roles.append(role)
        role = int(came[role])
    return roles[::-1]


def units_of(declared: str | None, text: str) -> list[tuple[Unit, str]]:
    """A row's units with their texts without markers: its lines, of which those without a marker of their own join the one before."""
    role = {"system": 0, "user": 1, "assistant": 2}.get((declared or "").strip().lower(), _NAMES.get((declared or "").strip().lower()))
    pieces: list[tuple] = []
    for k, line in enumerate(_END.sub("", _END_BEFORE.sub("\n", text)).split("\n")):
        marked, sure, written = _read(line)
        if k == 0 or marked is not None:
            pieces.append((marked, sure, written, [line[len(written) :]]))
        else:
            pieces[-1][3].append(line)
    out = []
    for k, (marked, sure, written, lines) in enumerate(pieces):
        body = "\n".join(lines)
        out.append((Unit(k == 0, role, marked, _feature(len(body), "?" in body), sure, written), body))
    return out


def fit(conversations: DataFrame) -> Model:
    """Counts over all rows with a known role: first roles, pairs of neighbours, lengths and question marks by role.

    Neighbours are found by a join on the turn before, so a conversation of any
    length is spread over tasks; only a few dozen counts reach the driver.
    """
    known = conversations.where(F.col("role").isin(*ROLES)).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.length(F.coalesce("text", F.lit(""))).alias("n"), F.contains(F.coalesce("text", F.lit("")), F.lit("?")).alias("asks"))
    size = sum((F.when(F.col("n") >= b, 1).otherwise(0) for b in _LENGTHS), F.lit(0))
    turns = known.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    pairs = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("was")).join(turns, ["conv_id", "turn"]).groupBy("was", "role").count()
    first = turns.where("turn = 0").groupBy("role").count()
    number = {r: i for i, r in enumerate(ROLES)}
    starts, moves, features = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 2 * _FEATURES))
    for r in first.collect():
        starts[number[r["role"]]] = r["count"]
    for r in pairs.collect():
        moves[number[r["was"]], number[r["role"]]] = r["count"]
    for r in known.groupBy("role", size.alias("size"), "asks").count().collect():
        features[number[r["role"]], 2 * r["size"] + r["asks"]] = r["count"]
    return Model(starts, moves, features)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one conversation's chunk at a time; rows come sorted."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv_id"], row["chunk"]) != (held[0]["conv_id"], held[0]["chunk"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


RENDERED = "conv_id long, turn long, part long, role string, text string, rendered string, declared string"


def format_chats(conversations: DataFrame, model: Model | None = None) -> DataFrame:
    """One row for each recovered turn: its row's turn, its part of that row, role, text and canonical rendering.

    A row's text is one unit, or several where lines within it open with what
    looks like a speaker marker ("User:", "### Assistant", "[human]" and the
    like). Names without a colon or bracket need a line of their own. The roles
    are the best path of a hidden Markov model: markers speak most strongly,
    then the role that the row declares for all its lines, then length and
    question marks, and turns follow each other as they do in all conversations;
    a marked line within a row may also be text of the turn before it. Only then
    are markers cut off: those whose role the path has, where a weak one ("Model:",
    "A:") must also change the role within its row or open a row that declares
    none. All others stay as text. Neighbouring units of a row that get the same
    role are one turn.

    Conversations of more than CHUNK rows are decoded in chunks of CHUNK rows at
    most, cut by the rows' order and not by turn, so that many rows of one turn
    are spread too: best-path scores across each chunk are combined first, so
    that the result is that of one pass over the conversation. Rows come by turn, ties by role and text; rows
    that repeat one entirely count once. Null texts are empty; unknown and null
    roles are undeclared; null conv_ids and turns are one conversation and turn
    0. An empty table gives no rows; further columns are ignored.
    """
    model = model or fit(conversations)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("one")).drop("one")
    long = materialise(rows.groupBy("conv_id").count().where(F.col("count") > CHUNK).select("conv_id"))
    if long.isEmpty():
        return _decode(_sorted(rows.withColumns({"chunk": F.lit(0).cast("long"), "entry": F.lit(None).cast("array<double>"), "exit": F.lit(None).cast("int")})), model)
    same = rows.conv_id.eqNullSafe(long.conv_id)
    short, rest = rows.join(long, same, "left_anti").withColumn("chunk", F.lit(0).cast("long")), materialise(_chunked(rows.join(long, same, "left_semi")))
    plans = _plan(materialise(_matrices(_sorted(rest), model)), model)
    placed = rest.alias("r").join(plans.alias("p"), F.expr("r.conv_id <=> p.conv_id AND r.chunk = p.chunk")).select("r.*", "p.entry", "p.exit")
    return _decode(_sorted(short.withColumns({"entry": F.lit(None).cast("array<double>"), "exit": F.lit(None).cast("int")}).unionByName(placed)), model)


def _chunked(rows: DataFrame) -> DataFrame:
    """rows with chunks that rise in their order, over all conversations, and have CHUNK rows at most, whatever the turns say.

    The order is a range partition over all that tells rows apart; the numbers
    hold for one run only, so the result is to be materialised.
    """
    keys = ["conv_id", "turn", "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("chunk", F.floor(F.monotonically_increasing_id() / CHUNK))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "turn", "role", "text")


def _matrices(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _chunks(batches):
            units = [u for row in group for u, _ in units_of(row["role"], row["text"])]
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([group[0]["conv_id"]], pa.int64()), "chunk": pa.array([group[0]["chunk"]], pa.int64()), "matrix": pa.array([across(model.steps(units)).ravel().tolist()], pa.list_(pa.float64()))})

    return rows.mapInArrow(run, "conv_id long, chunk long, matrix array<double>")


def _plan(matrices: DataFrame, model: Model) -> DataFrame:
    """Each chunk's entry scores and last role; a conversation's chunks are few numbers each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _chunks(row.set_column(1, "chunk", pa.nulls(row.num_rows, pa.int64())).append_column("own", row.column(1)) for row in batches):
            steps = [np.array(row["matrix"]).reshape(len(model.before), -1) for row in group]
            roles = viterbi(model.before, steps, None)
            entries = [model.before, *(np.where(np.arange(len(model.before)) == r, 0.0, -np.inf) for r in roles[:-1])]
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([row["conv_id"] for row in group], pa.int64()), "chunk": pa.array([row["own"] for row in group], pa.int64()), "entry": pa.array([e.tolist() for e in entries], pa.list_(pa.float64())), "exit": pa.array(roles, pa.int32())})

    return matrices.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(run, "conv_id long, chunk long, entry array<double>, exit int")


def _body(unit: Unit, text: str, role: int, before: int | None) -> str:
    """A unit's text under its decoded role, with its marker unless that is one; before is the role of the row's unit before it."""
    turns = role != before and (not unit.opens or unit.declared is None)
    return text if role == unit.marked and (unit.sure > _WEAK or turns) else unit.cut + text


def _merged(units: list[tuple], roles: list[int]) -> Iterator[tuple[dict, int, int, str]]:
    """(row, part, role, text) of the turns: neighbouring units of one row and role are one."""
    held = None
    for (row, part, unit, text), role in zip(units, roles, strict=True):
        same_row = held is not None and held[0] is row
        body = _body(unit, text, role, held[2] if same_row else None).strip()
        if same_row and held[2] == role:
            held = (row, held[1], role, f"{held[3]}\n{body}".strip())
        else:
            if held:
                yield held
            held = (row, part, role, body)
    if held:
        yield held


def agreement(conversations: DataFrame) -> DataFrame:
    """(declared, role, n): roles recovered from markers, lines and turn order alone against the declared ones."""
    blind = format_chats(conversations.withColumn("role", F.lit(None).cast("string")), fit(conversations)).where("part = 0").select("conv_id", "turn", "role")
    told = conversations.where(F.col("role").isin(*ROLES)).groupBy("conv_id", "turn").agg(F.min("role").alias("declared"))
    return told.join(blind, ["conv_id", "turn"]).groupBy("declared", "role").agg(F.count("*").alias("n"))


def _decode(rows: DataFrame, model: Model) -> DataFrame:
    names = [c.split()[0] for c in RENDERED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in _chunks(batches):
            units = [(row, part, unit, body) for row in group for part, (unit, body) in enumerate(units_of(row["role"], row["text"]))]
            entry = model.before if group[0]["entry"] is None else np.array(group[0]["entry"])
            roles = viterbi(entry, model.steps([u for _, _, u, _ in units]), group[0]["exit"])
            for row, part, role, text in _merged(units, roles):
                out.append((row["conv_id"], row["turn"], part, ROLES[role], text, TEMPLATE.format(role=ROLES[role], text=text), row["role"]))
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.string()) for k, c in enumerate(zip(*out, strict=True))], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.string()) for k, c in enumerate(zip(*out, strict=True))], names=names)

    return rows.mapInArrow(run, RENDERED)
