"""Secret scans: plain patterns, and weak candidates that are linked to complementary credential parts nearby."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "weak")

#: Code points on either side of a weak candidate in which a complementary part counts.
SCOPE = 200
#: Least bits a character of a weak candidate, and the least share of the most that a short one could have.
MIN_ENTROPY, ENTROPY_SHARE = 3.0, 0.75
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_IDENTIFIER = re.compile(r"""\b(?:user_?name|user_?id|login|client_?id|account_?id|access_?key(?:_?id)?|tenant_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.=-]{3,}""", re.ASCII | re.IGNORECASE)
#: URLs count with credentials or a service's scheme, or as a setting's value; a link in prose says nothing about secrets.
_ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+]{1,15}://[^\s"'<>/@:]+(?::[^\s"'<>/@]*)?@[^\s"'<>]+|(?!https?:)[a-z][a-z0-9+]{1,15}://[^\s"'<>]+|(?:host|hostname|server|endpoint|base_?url|api_?url)["']?\x20*[:=]\x20*["']?(?:https?://)?[A-Za-z0-9._:-]{3,}[^\s"'<>]*)""", re.ASCII | re.IGNORECASE)
_WEAK_ASSIGN = re.compile(r"""\b(?:pwd|pass|passphrase|key|private_?key|credential|auth|sig|signature)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@#$%^&*-]{6,})""", re.ASCII | re.IGNORECASE)
_WEAK_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])", re.ASCII)

_SEPARATORS = re.compile(r"[-_/.=+]+")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, number of the kind, end) of the base patterns, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def entropy(value: str) -> float:
    """Bits a character, from the value's own characters."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _looks_random(value: str) -> bool:
    """Whether a value is no word or name: half of it in parts that mix letters and digits, and its characters differ enough for its length.

    Numbers and words that separators join (ISBNs, versions, slugs) mix nothing
    within a part.
    """
    mixed = sum(len(p) for p in _SEPARATORS.split(value) if re.search(r"\d", p) and re.search(r"[A-Za-z]", p))
    return 2 * mixed >= len(value) and entropy(value) >= min(MIN_ENTROPY, ENTROPY_SHARE * math.log2(len(value)))


def weak_links(text: str, base: list[Span], scope: int = SCOPE) -> list[tuple[Span, Span, str]]:
    """Weak candidates with the nearest complementary part within scope: (candidate, part, kind of part).

    Identifiers are access keys and assigned user, client or account names;
    endpoints are URLs with credentials or of services, and assigned hosts.
    Weak candidates are secrets that the base patterns leave out: assignments to
    less telling names and long runs, if they look random. They are searched in the whole text, so that one
    which reaches beyond the scope stays whole. The join is an interval join:
    both sides lie in rising order and each candidate looks up its neighbours by
    bisection.
    """
    parts = [(s, e, "access") for s, k, e in base if k == 1]
    if "=" in text or ":" in text:
        parts += [(m.start(), m.end(), "identifier") for m in _IDENTIFIER.finditer(text)]
        parts += [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text)]
    if not parts:
        return []
    parts.sort()
    taken, within = _merged(sorted((s, e) for s, _, e in base)), _merged([(p[0], p[1]) for p in parts])
    starts = [p[0] for p in parts]
    # parts may hold others, so the nearest one before is that with the last end; of equal ends the one that begins first
    closed = sorted(reversed(parts), key=lambda p: p[1])
    ends = [p[1] for p in closed]
    # an assignment counts by its value, a run as it is
    found = {m.span(): m[1] for m in _WEAK_ASSIGN.finditer(text)}
    found |= {m.span(): m[0] for m in _WEAK_RUN.finditer(text)}
    out, last = [], 0
    for s, e in sorted(found):
        before, after = bisect_right(ends, s), bisect_left(starts, e)
        near = [p for p in closed[max(0, before - 1) : before] + parts[after : after + 1] if p[0] - e <= scope and s - p[1] <= scope]
        if s < last or not near or not _looks_random(found[s, e]):
            continue
        if _overlaps(taken, s, e) or _overlaps(within, s, e):
            continue
        part = min(near, key=lambda p: (max(p[0] - e, s - p[1]), p))
        out.append(((s, 3, e), (part[0], 3, part[1]), part[2]))
        last = e
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _overlaps(merged: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether the span shares a place with one of the merged ones, which rise: the last that begins before its end tells."""
    at = bisect_left(merged, (end,)) - 1
    return at >= 0 and merged[at][1] > start


def rendered(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """text with the mark in place of every span; overlapping spans share one."""
    out, last = [], 0
    for low, high in _merged(sorted((s, e) for s, _, e in spans)):
        out += [text[last:low], mark]
        last = high
    return "".join([*out, text[last:]])


def _texts(documents: DataFrame) -> DataFrame:
    return text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def scan(documents: DataFrame) -> DataFrame:
    """One row a document: base counts, the digest of its base spans, and all spans with the linked weak ones.

    Spans count code points of the whole text, ends exclusive. Null and empty
    texts have none. Repeated rows are scanned each for itself; an empty table
    gives no rows; further columns are ignored. One narrow pass, so no key can
    be hot and a lost task is simply run again.
    """
    schema = {"doc_id": "long", "n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string", "n_weak": "long", "links": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            texts = texts.to_pylist()
            rows = []
            for text in texts:
                base = base_spans(text)
                links = weak_links(text, base)
                kinds = Counter(k for _, k, _ in base)
                every = sorted([*base, *(w for w, _, _ in links)])
                rows.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(rendered(base).encode()).hexdigest(), rendered(every), len(links), ",".join(f"weak:{w[0]}:{w[2]}>{kind}:{p[0]}:{p[2]}" for w, p, kind in links)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=pa.int64() if k == "long" else pa.string()) for c, k in zip(columns, list(schema.values())[1:], strict=True))], names=list(schema))

    return _texts(documents).mapInArrow(run, ", ".join(f"{c} {k}" for c, k in schema.items()))


def redact(documents: DataFrame) -> DataFrame:
    """documents with every found secret replaced by a mark; texts without one, and nulls, stay as they are.

    All rows and columns stay; a column n_chars follows the new text.
    """
    fields = documents.schema
    at = fields.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            texts = texts.to_pylist()
            old = batch.column(at).to_pylist()
            new = []
            for raw, text in zip(old, texts, strict=True):
                base = base_spans(text)
                spans = [*base, *(w for w, _, _ in weak_links(text, base))]
                new.append(redacted(text, spans) if spans else raw)
            columns = [pa.array(new, type=batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = text_batches(documents).mapInArrow(run, fields)
    return out.withColumn("n_chars", F.length("text").cast(fields["n_chars"].dataType)) if "n_chars" in fields.names else out
