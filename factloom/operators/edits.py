"""Word-level edits between two texts: an edit script, and what kind of change each edit is."""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .. import lexicons as lx

NUMBER, NEGATION, INSERTION, ORDER, TYPO, WORDING = lx.EDIT_KINDS
#: Kinds that look like a change of meaning.
CRITICAL = (NUMBER, NEGATION, INSERTION)
#: Longest run of letters that a typo changes, and the least length of its words.
TYPO_SPAN, TYPO_WORD = 3, 6
#: Words from which on a text alone on one side is an insertion (or an omission).
INSERTED = 3

_DIGIT = re.compile(r"\d")
_MARKS = frozenset(lx.STRIPPED)
_PARTICLES = frozenset(lx.NEGATION_PARTICLES)
_PLACES = ("a_from", "a_to", "b_from", "b_to")
EDITS = StructType([StructField("edits", ArrayType(StructType([*(StructField(n, IntegerType()) for n in _PLACES), StructField("kind", StringType())]))), StructField("kinds", ArrayType(StringType())), StructField("n_equal", IntegerType())])


def plain(word: str) -> str:
    """A word in lower case without the marks at its ends."""
    return word.strip(lx.STRIPPED).lower()


def is_typo(a: str, b: str) -> bool:
    """Whether two words differ in one short run of letters and are long enough to be the same word."""
    a, b = plain(a), plain(b)
    if a == b or min(len(a), len(b)) < TYPO_WORD:
        return False
    changed = [max(i2 - i1, j2 - j1) for tag, i1, i2, j1, j2 in SequenceMatcher(None, a, b, False).get_opcodes() if tag != "equal"]
    return len(changed) == 1 and changed[0] <= TYPO_SPAN


def kind_of(a: list[str], b: list[str]) -> str:
    """What kind of change turns the words a into b, of which one may be empty."""
    own, other = {plain(w) for w in a}, {plain(w) for w in b}
    if any(map(_DIGIT.search, a + b)):
        return NUMBER
    if own & _PARTICLES != other & _PARTICLES:
        return NEGATION
    if not a or not b:
        alone = a or b
        if len(alone) >= INSERTED:
            return INSERTION
        return ORDER if all(_MARKS.issuperset(w) for w in alone) else WORDING
    if len(a) == len(b) == 1 and is_typo(a[0], b[0]):
        return TYPO
    return ORDER if own == other or plain(" ".join(a)) == plain(" ".join(b)) else WORDING


def script(a: str | None, b: str | None) -> tuple[list[tuple[int, int, int, int, str]], list[str], int]:
    """The edits that turn a's words into b's, their kinds without repeats, and how many words stay.

    Words are compared without case and marks at their ends; equal runs are
    taken longest first. Texts without an edit, and those whose edits only move
    words about, are of one kind: order. Null counts as empty.
    """
    x, y = (a or "").split(), (b or "").split()
    found = [(i1, i2, j1, j2) for tag, i1, i2, j1, j2 in SequenceMatcher(None, [plain(w) for w in x], [plain(w) for w in y], False).get_opcodes() if tag != "equal"]
    stays = len(x) - sum(i2 - i1 for i1, i2, _, _ in found)
    gone = Counter(w for i1, i2, _, _ in found for w in map(plain, x[i1:i2]) if w)
    come = Counter(w for _, _, j1, j2 in found for w in map(plain, y[j1:j2]) if w)
    moved = gone == come and bool(gone)
    edits = [(i1, i2, j1, j2, ORDER if moved else kind_of(x[i1:i2], y[j1:j2])) for i1, i2, j1, j2 in found]
    return edits, sorted({e[4] for e in edits}) or [ORDER], stays


@F.arrow_udf(EDITS)
def edit_script(a: pa.Array, b: pa.Array) -> pa.Array:
    """script() of every row; memory grows with the words of one pair, not with their product."""
    done = [script(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    ends, kind_ends, flat = [0], [0], []
    for edits, kinds, _ in done:
        flat += edits
        ends.append(ends[-1] + len(edits))
        kind_ends.append(kind_ends[-1] + len(kinds))
    columns = [pa.array([e[k] for e in flat], pa.int32()) for k in range(4)] + [pa.array([e[4] for e in flat], pa.string())]
    edits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, [*_PLACES, "kind"]))
    kinds = pa.ListArray.from_arrays(pa.array(kind_ends, pa.int32()), pa.array([k for _, kinds, _ in done for k in kinds], pa.string()))
    return pa.StructArray.from_arrays([edits, kinds, pa.array([n for _, _, n in done], pa.int32())], ["edits", "kinds", "n_equal"])


def with_edits(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with edits (places in words, from and to on both sides, and kind), kinds and n_equal.

    Row by row, without a shuffle. Repeated rows are compared each for itself;
    an empty table gives no rows.
    """
    return pairs.withColumn("_script", edit_script(F.col(a).cast("string"), F.col(b).cast("string"))).select(*pairs.columns, "_script.*")


def legend_warnings(pairs: DataFrame, reference: str = "reference", candidate: str = "candidate") -> DataFrame:
    """(row_no, dtype, severity, n, n_critical, warned): rows of a legend whose benign label most texts' edits deny.

    pairs: row_no, dtype, severity and the two texts. A check of the set, not of
    the texts: it tells where a file's rows no longer fit their legend.
    """
    looks = F.arrays_overlap("kinds", F.array(*map(F.lit, CRITICAL)))
    rows = with_edits(pairs.select("row_no", "dtype", "severity", reference, candidate), reference, candidate)
    out = rows.groupBy("row_no", "dtype", "severity").agg(F.count("*").alias("n"), F.count_if(looks).alias("n_critical"))
    return out.withColumn("warned", (F.col("severity") == "benign") & (F.col("n_critical") > F.floor(F.col("n") / 2)))
