"""Hard negatives: an exact kNN join over a Voronoi partition of norm-augmented vectors.

With M the greatest norm, a row x becomes (x, sqrt(M^2 - |x|^2)) and an anchor
q becomes (q, 0), so that the squared distance |q|^2 + M^2 - 2 q.x falls as the
inner product rises. Rows and anchors know their distances to a few pivots;
the triangle inequality then tells which rows an anchor group can't need.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Components are floor(SCALE * x), limited to +-LIMIT so that scores fit 64 bits.
SCALE, LIMIT = 256, 1 << 24
#: Rows with the least hashes of their ids, from which pivots are fitted and first bounds are taken; fewer if vectors are long.
PILOT, PILOT_VALUES = 4096, 4_000_000
#: Voronoi cells, and the groups of neighbouring cells to which rows are replicated.
PIVOTS, GROUPS = 32, 8
#: Rows of a pack, of a task's share of a group, and anchors of a task.
PACK, SPLIT, ANCHORS = 4096, 16_384, 8192
_CHUNK = 64

_PACKED = "ids binary, labels binary, flags binary, values binary, width int, dims int, n int, peak long, norm double"


class Block(NamedTuple):
    """Rows as arrays; values are whole numbers."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray

    def take(self, at: np.ndarray) -> Block:
        return Block(*(x[at] for x in self))


def _matrix(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The lists as rows of float64, padded with zeros, and which of them have no null or non-finite value."""
    lists = lists.cast(pa.list_(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    if lists.null_count:
        sizes[lists.is_null().to_numpy(zero_copy_only=False)] = 0
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    inside = np.arange(int(sizes.max(initial=0))) < sizes[:, None]
    out = np.zeros(inside.shape)
    out[inside] = flat
    return np.where(np.isfinite(out), out, 0.0), np.isfinite(out).all(axis=1)


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) in doubles, in the smallest type that holds it."""
    out = np.clip(np.floor(SCALE * values), -LIMIT, LIMIT)
    return out.astype(np.int16 if np.abs(out).max(initial=0) < 1 << 15 else np.int32)


def _packed(rows: DataFrame) -> DataFrame:
    """Packs of up to PACK rows (id, label, flag, vector) as bytes; rows with null or non-finite components are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, PACK) for k in range(0, batch.num_rows, PACK)):
                found, sound = _matrix(part.column(3))
                if not sound.any():
                    continue
                values = _whole(found[sound])
                ids, labels, flags = (part.column(k).to_numpy(zero_copy_only=False)[sound] for k in range(3))
                norm = np.square(values.astype(np.float64)).sum(axis=1).max(initial=0)
                row = (ids.astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), flags.astype(np.uint8).tobytes(), values.tobytes(), values.itemsize, values.shape[1], len(values), int(np.abs(values.astype(np.int64)).max(initial=0)), float(norm))
                yield pa.RecordBatch.from_pylist([dict(zip((c.split()[0] for c in _PACKED.split(", ")), row, strict=True))], schema=_ARROW)

    return rows.mapInArrow(run, _PACKED)


_TYPES = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _PACKED.split(", ")])


def _values(raw: bytes, width: int, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if width == 2 else np.int32).reshape(n, dims)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), _values(row["values"], row["width"], row["dims"], row["n"])), np.frombuffer(row["flags"], np.uint8).astype(bool)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows; beyond the shorter ones' dimensions all is zero."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = d * int(np.abs(a.astype(np.int64)).max(initial=0)) * int(np.abs(b.astype(np.int64)).max(initial=0))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def _first(found: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's first k fitting entries: higher ones first, ties by smaller id; in that order."""
    least = np.iinfo(np.int64).min // 2 if found.dtype.kind == "i" else -np.inf
    held = np.where(fits, found, least)
    if held.shape[1] > k:
        bar = held.shape[1] - k
        held[held < np.partition(held, bar, axis=1)[:, bar : bar + 1]] = least
    at, column = np.nonzero(held > least)
    order = np.lexsort((ids[column], -held[at, column], at))
    at, column = at[order], column[order]
    starts = np.searchsorted(at, np.arange(len(found)))
    keep = np.arange(len(at)) - starts[at] < k
    return at[keep], column[keep]


def _window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest whole negative score for each positive one."""
    return -((-low * positive) // 100), (high * positive) // 100


class Space(NamedTuple):
    """Pivots of the augmented space, the group of each one's cell, the greatest squared norm, and the pilot rows."""

    pivots: np.ndarray
    group: np.ndarray
    norm: float
    pilot: Block

    def distances(self, values: np.ndarray, anchors: bool) -> np.ndarray:
        """Distances to all pivots; anchors have no added component."""
        x = values.astype(np.float64)
        d = min(x.shape[1], self.pivots.shape[1] - 1)
        own = np.square(x).sum(axis=1)
        square = np.square(self.pivots).sum(axis=1) - 2 * x[:, :d] @ self.pivots[:, :d].T
        if anchors:
            square += own[:, None]
        else:
            square += self.norm - 2 * np.sqrt(np.maximum(self.norm - own, 0))[:, None] * self.pivots[:, -1]
        return np.sqrt(np.maximum(square, 0))

    def radius(self, values: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a row has this score with each anchor; a score of minus infinity is infinitely far."""
        return np.sqrt(np.maximum(np.square(values.astype(np.float64)).sum(axis=1) + self.norm - 2 * score, 0))

    @property
    def slack(self) -> float:
        """More than the rounding of any distance."""
        return 1e-4 * max(1.0, self.norm**0.5)


def _space(rows: DataFrame, norm: float, dims: int) -> Space:
    """Pivots by a few rounds of k-means over the pilot rows, whose number is bounded; results don't depend on them, only the work does."""
    size = max(PIVOTS, min(PILOT, PILOT_VALUES // max(1, dims)))
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(size).select("id", "label", "vector").toArrow()
    found, sound = _matrix(taken.column("vector").combine_chunks()) if taken.num_rows else (np.zeros((0, dims)), np.zeros(0, bool))
    pilot = Block(taken.column("id").to_numpy()[sound], taken.column("label").to_numpy()[sound].astype(np.int64), _whole(found[sound]))
    x = np.zeros((len(pilot.ids), dims + 1))
    x[:, : pilot.values.shape[1]] = pilot.values
    x[:, -1] = np.sqrt(np.maximum(norm - np.square(x).sum(axis=1), 0))
    pivots = x[_spread(x, PIVOTS)]
    for _ in range(4):
        cell = _nearest(x, pivots)
        pivots = np.array([x[cell == k].mean(axis=0) if (cell == k).any() else p for k, p in enumerate(pivots)]).reshape(pivots.shape)
    return Space(pivots, _nearest(pivots, pivots[_spread(pivots, GROUPS)]), norm, pilot)


def _nearest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.argmin(np.square(y).sum(axis=1) - 2 * x @ y.T, axis=1) if len(y) else np.zeros(len(x), np.intp)


def _spread(x: np.ndarray, k: int) -> list[int]:
    """Places of up to k different rows, each the farthest from those before."""
    chosen, far = [], np.full(len(x), np.inf)
    while len(chosen) < min(k, len(x)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, np.square(x - x[chosen[-1]]).sum(axis=1))
    return chosen


_ANCHOR = "anchor_id long, label long, vector binary, dims int, cell int, team int, away array<double>, far double, near double"


def _anchors(packs: DataFrame, space: Space, k: int) -> DataFrame:
    """The anchors with their cell, group, distances to the pivots, and how far their k-th positive lies at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, flags in _blocks(batches):
            if not flags.any():
                continue
            own = block.take(flags)
            away = space.distances(own.values, True)
            cell = np.argmin(away, axis=1)
            found = scores(own.values, space.pilot.values)
            fits = (own.labels[:, None] == space.pilot.labels) & (own.ids[:, None] != space.pilot.ids)
            at, column = _first(found, fits, space.pilot.ids, k)
            floor = _last(len(own.ids), at, found[at, column], k, np.full(len(own.ids), -np.inf))
            wide = own.values.astype(np.int32)
            columns = (own.ids, own.labels, [v.tobytes() for v in wide], np.full(len(wide), wide.shape[1]), cell, space.group[cell], away.tolist(), space.radius(own.values, floor), np.zeros(len(wide)))
            yield _batch(columns, _ANCHOR)

    return packs.mapInArrow(run, _ANCHOR)


def _last(n: int, at: np.ndarray, found: np.ndarray, k: int, other: np.ndarray) -> np.ndarray:
    """Each row's k-th entry where it has k; other's elsewhere. at rises, entries fall."""
    out = other.astype(np.float64)
    ends = np.searchsorted(at, np.arange(n), side="right")
    full = np.diff(np.concatenate([[0], ends])) >= k
    out[full] = found[ends[full] - 1]
    return out


_COLUMN = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64())}


def _batch(columns: tuple, schema: str) -> pa.RecordBatch:
    fields = [c.split(" ", 1) for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _COLUMN[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _table(columns: tuple, schema: str) -> pa.Table:
    return pa.Table.from_batches([_batch(columns, schema)])


def _served(packs: DataFrame, anchors: DataFrame, space: Space) -> DataFrame:
    """(team, pack, rows as bytes): each row once for every group with a cell whose anchors it might serve.

    Of each cell's anchors the least and greatest distance to every pivot are
    known, and the ring between near and far in which they search: a row whose
    distances to some pivot put it outside of the ring for all of them is not
    sent.
    """
    cells, bound = len(space.pivots), np.zeros((4, len(space.pivots)))
    low, high = np.full((cells, cells), np.inf), np.full((cells, cells), -np.inf)
    for r in anchors.select("cell", F.posexplode("away")).groupBy("cell", "pos").agg(F.min("col").alias("low"), F.max("col").alias("high")).collect():
        low[r.cell, r.pos], high[r.cell, r.pos] = r.low, r.high
    bound[0] = -np.inf
    for r in anchors.groupBy("cell").agg(F.max("far").alias("far"), F.min("near").alias("near")).collect():
        bound[0, r.cell], bound[1, r.cell] = r.far, r.near
    present = np.flatnonzero(np.isfinite(low).any(axis=1))
    schema = "team int, pack long, ids binary, labels binary, values binary, width int, dims int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in _blocks(batches):
            away = space.distances(block.values, False)
            wanted: dict[int, np.ndarray] = {}
            for c in present.tolist():
                least = np.maximum(low[c] - away, away - high[c]).max(axis=1)
                most = (away + high[c]).min(axis=1)
                need = (least <= bound[0, c] + space.slack) & (most >= bound[1, c] - space.slack)
                team = int(space.group[c])
                wanted[team] = wanted[team] | need if team in wanted else need
            rows = [(t, int(block.ids[0]), own.ids.tobytes(), own.labels.tobytes(), own.values.tobytes(), own.values.itemsize, own.values.shape[1], len(own.ids)) for t, m in wanted.items() if m.any() for own in (block.take(m),)]
            if rows:
                yield _batch(tuple(zip(*rows, strict=True)), schema)

    return packs.mapInArrow(run, schema)


def _joined(served: DataFrame, anchors: DataFrame, rows: int, many: int, match, schema: str) -> DataFrame:
    """match(anchors' table, their block, rows' block) over every share of a group and every share of its anchors."""
    splits, shares = max(1, -(-rows // SPLIT)), max(1, -(-many // ANCHORS))
    left = served.withColumn("split", F.pmod(F.xxhash64("pack"), F.lit(splits)).cast("int")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    right = anchors.drop("away", "cell").withColumn("share", F.pmod(F.xxhash64("anchor_id"), F.lit(shares)).cast("int")).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    empty = tuple([] for _ in schema.split(", "))

    def run(packs: pa.Table, own: pa.Table) -> pa.Table:
        if not packs.num_rows or not own.num_rows:
            return _table(empty, schema)
        sizes = own.column("dims").to_numpy()
        values = np.zeros((own.num_rows, int(sizes.max(initial=0))), np.int32)
        values[np.arange(values.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(own.column("vector").to_pylist()), np.int32)
        asking = Block(own.column("anchor_id").to_numpy(), own.column("label").to_numpy(), values)
        parts = [match(own.slice(k, _CHUNK), asking.take(slice(k, k + _CHUNK)), block) for block in map(_of_row, packs.to_pylist()) for k in range(0, own.num_rows, _CHUNK)]
        return pa.concat_tables(parts) if parts else _table(empty, schema)

    keys = ("team", "share", "split")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _of_row(row: dict) -> Block:
    return Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), _values(row["values"], row["width"], row["dims"], row["n"]))


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's hard negatives.

    vectors: vec_id, label, embedding; anchor tells which rows are anchors. A
    score is the inner product of floor(256 * x); higher ones come first, ties
    by smaller id. An anchor's positives are its first ones among the other
    rows of its label; a positive's negatives are the first rows of other
    labels with low % to high % of the positive's score.

    Two passes of one exact join: positives first, whose scores then bound the
    ring in which negatives lie. In both, a bounded pilot gives each anchor a
    first bound, and rows go only to the groups of anchors that they might
    serve, in shares of bounded size, so that a cell with a third of all rows
    (or of all anchors) is many tasks. Vectors without structure can't be
    pruned: then every row goes to all GROUPS groups, once for every ANCHORS
    anchors, which is the stated query set against all rows in blocks.

    Rows with a null id, label, vector or component, or a component that isn't
    finite, take no part. Components beyond +-2^24 count as that. A shorter
    vector is continued with zeros. Of rows with the same id the one with the
    least label, then vector, takes part. Anchors without positives and
    positives without negatives give no rows; so does an empty table. Further
    columns are ignored.
    """
    rows = _one_each(vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("flag"), F.col("embedding").cast("array<double>").alias("vector")).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"))
    packs = materialise(_packed(rows))
    n, norm, dims = packs.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0)), F.coalesce(F.max("dims"), F.lit(0))).first()
    space = _space(rows, norm, dims)
    asking = materialise(_anchors(packs, space, positives))
    many = asking.count()

    def nearest(own: pa.Table, asked: Block, block: Block) -> pa.Table:
        found = scores(asked.values, block.values)
        at, column = _first(found, (asked.labels[:, None] == block.labels) & (asked.ids[:, None] != block.ids), block.ids, positives)
        return _table((asked.ids[at], block.ids[column], found[at, column].astype(np.int64)), "anchor_id long, id long, score long")

    near = _joined(_served(packs, asking, space), asking, n, many, nearest, "anchor_id long, id long, score long")
    first = _ranked(near, positives, "anchor_id").groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    known = first.select("anchor_id", F.col("found.id").alias("positive_ids"), F.col("found.score").alias("positive_scores"))
    ringed = materialise(_ringed(asking.join(known, "anchor_id"), space, negatives, low, high))
    schema = "anchor_id long, positive_id long, positive_score long, id long, score long"

    def ring(own: pa.Table, asked: Block, block: Block) -> pa.Table:
        found = scores(asked.values, block.values)
        other = asked.labels[:, None] != block.labels
        ids, own_scores = own.column("positive_ids").to_pylist(), own.column("positive_scores").to_pylist()
        parts = []
        for k in range(max(map(len, ids), default=0)):
            has = np.array([len(x) > k for x in ids])
            score = np.array([x[k] if len(x) > k else 0 for x in own_scores], np.int64)
            name = np.array([x[k] if len(x) > k else 0 for x in ids], np.int64)
            least, most = _window(score, low, high)
            at, column = _first(found, other & has[:, None] & (found >= least[:, None]) & (found <= most[:, None]), block.ids, negatives)
            parts.append(_table((asked.ids[at], name[at], score[at], block.ids[column], found[at, column].astype(np.int64)), schema))
        return pa.concat_tables(parts) if parts else _table(([], [], [], [], []), schema)

    hard = _joined(_served(packs, ringed, space), ringed, n, many, ring, schema)
    return _ranked(hard, negatives, "anchor_id", "positive_id").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _one_each(rows: DataFrame) -> DataFrame:
    """rows with one row of each id; only ids that repeat, if there are any, cost a shuffle of vectors."""
    again = materialise(rows.groupBy("id").count().where("count > 1").select("id"))
    if again.isEmpty():
        return rows
    one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector", "flag")).alias("least")).select("id", "least.label", "least.flag", "least.vector")
    return rows.join(again, "id", "left_anti").unionByName(one)


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first k of each key's rows over all shares, numbered from 1; every share has sent k at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ringed(asking: DataFrame, space: Space, k: int, low: int, high: int) -> DataFrame:
    """The anchors with the ring of distances that holds the negatives of all their positives."""
    schema = asking.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(s, _CHUNK) for s in range(0, whole.num_rows, _CHUNK)):
                far, near = [], []
                for row in batch.to_pylist():
                    values = np.frombuffer(row["vector"], np.int32)[None, :]
                    positive = np.array(row["positive_scores"], np.int64)
                    least, most = _window(positive, low, high)
                    found = np.repeat(scores(values, space.pilot.values), len(positive), axis=0)
                    fits = (row["label"] != space.pilot.labels) & (found >= least[:, None]) & (found <= most[:, None])
                    at, column = _first(found, fits, space.pilot.ids, k)
                    floor = _last(len(positive), at, found[at, column], k, least)
                    used = least <= most
                    # no window: a ring that no row lies in
                    ring = space.radius(values, np.array([floor[used].min(), most[used].max()])) if used.any() else (-np.inf, np.inf)
                    far.append(float(ring[0]))
                    near.append(float(ring[1]))
                columns = [pa.array(far, pa.float64()) if f.name == "far" else pa.array(near, pa.float64()) if f.name == "near" else c for f, c in zip(batch.schema, batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return asking.mapInArrow(run, schema)


#: The query's rows in DuckDB; vectors have at most 2^15 components there.
ORACLE = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, id, score FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negative AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10
"""
