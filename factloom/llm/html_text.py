"""Main text of web pages: lines shared with the page of the nearest URL are deleted, and structure tells template from article."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices
from .url_filters import host, path

# Elements and class words of web pages.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "select", "math", "head")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br caption".split())
_PLATE = frozenset("nav footer aside form menu dialog header fieldset".split())
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion cookie cookies consent gdpr notice notices sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer footers comment comments respond reply replies disqus share sharing social related recommended newsletter subscribe subscription signup popup modal overlay banner masthead topbar toolbar skip pagination pager widget widgets login search".split())

_COMMENTS = frozenset("comment comments reply replies respond disqus".split())
_ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsored promo promotion".split())
_HEADERS = frozenset(["header"])
_MODIFIERS = frozenset("has with no without is not show hide enable js".split())
_BOXES = frozenset("area bar block body bottom box button buttons container content div field frame group holder icon inner item items left link links list module panel posts region right row section slot text title top unit wrap wrapper".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[^<>=])*+)(>|(?=<)|\Z)|[^<]+|<", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PARTS = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_END_RAW = {n: re.compile(rf"</{n}\s*>", re.IGNORECASE) for n in _RAW}
_START_BODY = re.compile(r"</head\s*>|<body\b", re.IGNORECASE)

#: Where a line stands: in what no article has, in none of both, in an article.
PLATE, OPEN, ARTICLE = 0, 1, 2
#: Shared-line marks that are broadcast at most; beyond that the join shuffles.
BROADCAST_BYTES = 16_000_000


def _says(token: str, words: frozenset[str]) -> bool:
    """Whether a class or id is a template word: as a whole, as the head of a compound, or beside words for boxes alone.

    So cookie-banner and comment-list are, while social-history and has-sidebar
    tell about something else.
    """
    if token.lower() in words:
        return True
    parts = [p.lower() for p in _PARTS.split(token) if p]
    if len(parts) < 2 or parts[0] in _MODIFIERS:
        return False
    return parts[-1] in words or parts[0] in words and _BOXES.issuperset(p for p in parts[1:] if p not in words)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _plate(name: str, attributes: str, in_article: bool) -> str | None:
    """Why an element is template: "tag" (element, role or hidden), "comment" or "word" (its class or id); None if it isn't.

    Classes of html, body, main and article tell about the page, so there only
    those of comments count; within an article only whole words do.
    """
    if name in _PLATE and not (name == "header" and in_article):
        return "tag"
    if "=" not in attributes and "hidden" not in attributes.lower():
        return None
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in _ROLES:
        return "tag"
    tokens = [*found.get("class", "").split(), *found.get("id", "").split()]
    if name in ("html", "body", "main"):
        return None
    says = (lambda t, words: t.lower() in words) if in_article or name == "article" else _says
    if any(says(t, _COMMENTS) for t in tokens):
        return "comment"
    if name != "article" and any(says(t, _WORDS) for t in tokens):
        return "word"
    return "word" if not in_article and name not in ("article", "h1", "h2", "h3") and any(_says(t, _HEADERS) for t in tokens) else None


def _quiet(name: str, attributes: str) -> bool:
    """Whether an element within a line isn't part of its text: buttons, what is hidden, adverts."""
    if name == "button":
        return True
    if "=" not in attributes and "hidden" not in attributes.lower():
        return False
    found = _attributes(attributes)
    return "hidden" in found or found.get("aria-hidden", "").lower() == "true" or any(t.lower() in _ADVERTS for t in found.get("class", "").split())


def blocks(page: str) -> list[tuple[int, str]]:
    """(place, text) of every block with text, in page order; white space is one space, references are decoded."""
    out: list[tuple[int, str]] = []
    # open blocks: name, the place outside, and why it is template
    stack: list[tuple[str, int, str | None]] = []
    # the element within a line whose text is left out, how often it is open, and the blocks around it
    quiet: tuple[str, int, int] | None = None
    endless: set[str] = set()
    place, buffer, at, size = OPEN, [], 0, len(page)

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                out.append((place, text))
            buffer.clear()

    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if quiet:
                continue
            if page[m.start()] != "<" or m.end() == m.start() + 1:
                buffer.append(m[0])
            elif page.startswith("<![CDATA[", m.start()):
                buffer.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if not m[1] and name in _END_RAW:
            end = _END_RAW[name].search(page, at)
            if name == "head":
                body = _START_BODY.search(page, at)
                at = body.start() if body else at
            elif end:
                at = end.end()
            elif name in ("script", "style"):
                at = size
            continue
        if name not in _BLOCKS:
            if quiet and quiet[0] == name:
                depth = quiet[1] + (-1 if m[1] else 1)
                quiet = (name, depth, quiet[2]) if depth else None
            elif not quiet and not m[1] and name not in _VOID and name not in endless and _quiet(name, m[3]):
                if re.compile(rf"</{name}\b", re.IGNORECASE).search(page, at):
                    quiet = (name, 1, len(stack))
                else:  # nothing ends it here or further on
                    endless.add(name)
            continue
        flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    place = stack[k][1]
                    del stack[k:]
                    break
            if quiet and len(stack) < quiet[2]:  # its block has ended
                quiet = None
            continue
        if name in _ENDS_P and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            place = stack.pop()[1]
        if name in _VOID or m[3].endswith("/") and name not in ("p", "div", "article", "section"):
            continue
        why = _plate(name, m[3], place == ARTICLE)
        if name in ("article", "main") and not why and place == PLATE and all(w in (None, "word") for _, _, w in stack):
            stack.append((name, place, None))
            place = ARTICLE  # a word on a wrapper says nothing about the article within
            continue
        stack.append((name, place, why))
        if place != PLATE and why:
            place = PLATE
        elif place == OPEN and name in ("article", "main"):
            place = ARTICLE
    flush()
    return out


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of all of a and each beginning of b, by bit-parallel addition."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    free = full
    for x in a:
        used = free & places.get(x, 0)
        free = ((free + used) | (free - used)) & full
    bits = np.unpackbits(np.frombuffer(free.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _align(a: list[int], b: list[int], at: int, out: np.ndarray) -> None:
    """Marks in out, from at on, the elements of a that a longest common subsequence with b keeps; halves a until one is left."""
    low = 0
    while low < len(a) and low < len(b) and a[low] == b[low]:
        low += 1
    out[at : at + low] = True
    a, b, at = a[low:], b[low:], at + low
    end = 0
    while end < len(a) and end < len(b) and a[-1 - end] == b[-1 - end]:
        end += 1
    if end:
        out[at + len(a) - end : at + len(a)] = True
        a, b = a[:-end], b[:-end]
    if not a or not b:
        return
    if len(a) == 1:
        out[at] = a[0] in b
        return
    half = len(a) // 2
    cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[:half - 1 : -1], b[::-1])[::-1]))
    _align(a[:half], b[:cut], at, out)
    _align(a[half:], b[cut:], at + half, out)


def shared(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of own's lines a longest common subsequence with other's keeps. Memory grows with the lines, not with their product."""
    out = np.zeros(len(own), bool)
    _align(own.tolist(), other.tolist(), 0, out)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, its main text and the text's code points.

    Every page is paired with the one of the nearest URL: pages are ordered by
    host and path, and of the one before and the one after the one with the
    longer common beginning of the path counts. All text lines of the two are
    aligned by longest common subsequence, and the lines that both have are
    deleted. Structure refines this both ways: lines within an article or main
    element are content, so that an article keeps what another one repeats;
    menus, headers, footers, asides, forms, and elements whose class, id or
    role says so are template also where no other page has their lines.
    n_lines counts a page's lines, n_shared those that the alignment found.

    Pages of a host with the same lines are one page in the pairing, that of the
    least path, so that copies don't delete each other; a host with no other
    page tells nothing. Null and empty pages have an empty text. Equal URLs are
    ordered by page_id and by their place in the table. Repeated rows are judged
    each for itself; an empty table gives no rows; further columns are ignored.
    The order is a range partition of line hashes, so a host of any size is
    spread over tasks; each part lends its first and last page to its
    neighbours.

    A class or id marks an element only as a template word, not by having one
    in it (has-sidebar, social-history), and never html, body, main or an
    article; an article within a marked wrapper is content.
    """
    schema = "page_id long, url string, host string, path string, row long, lines array<string>, places array<int>, hashes array<long>, same long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, "html"):
            found = [blocks(page) for page in part.to_pylist()]
            lines = [[t for p, t in own if p != PLATE] for own in found]
            # of a line outside articles the number among all lines, else -1
            places = [[k if p == OPEN else -1 for k, (p, _) in enumerate(own) if p != PLATE] for own in found]
            hashes = [[xxhash.xxh3_64_intdigest(t) - (1 << 63) for _, t in own] for own in found]
            same = [xxhash.xxh3_64_intdigest("\n".join(f"{p} {t}" for p, t in own)) - (1 << 63) for own in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(lines, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())), pa.array(same, pa.int64())], names=[c.split()[0] for c in schema.split(", ")])

    url = F.col("url").cast("string")
    only = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"), F.monotonically_increasing_id().alias("row"), F.col("html").cast("string").alias("html"))
    found = materialise(only.mapInArrow(run, schema))
    gone = materialise(_shared_lines(found.where(F.size("hashes") > 0)))
    small = gone.agg(F.coalesce(F.sum(F.size("gone") + 40), F.lit(0))).first()[0] <= BROADCAST_BYTES
    gone = gone.select(F.col("host").alias("of"), F.col("same").alias("with"), "gone")
    placed = found.drop("path", "row").join(F.broadcast(gone) if small else gone, F.expr("host <=> of AND same = with"), "left")
    kept = F.filter(F.transform("lines", lambda t, i: F.when(~F.coalesce(F.get("gone", F.get("places", i)), F.lit(False)), t)), lambda t: t.isNotNull())
    out = placed.select("page_id", "url", F.array_join(kept, "\n").alias("text"), F.size("hashes").cast("long").alias("n_lines"), F.size(F.filter(F.coalesce("gone", F.array()), lambda x: x)).cast("long").alias("n_shared"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")


def _shared_lines(found: DataFrame) -> DataFrame:
    """(host, same, gone): for each host's pages of the same lines, which of their lines the page of the nearest URL shares; only where it shares some."""
    keys = ["host", "path", "page_id", "row"]
    # the least of pages with the same lines stands for all of them
    least = found.groupBy("host", "same").agg(F.min(F.struct("path", "page_id", "row")).alias("m")).select("m.row")
    lined = found.select(*keys, "same", "hashes").join(least, "row", "left_semi").select(*keys, "same", "hashes")
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = materialise(lined.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))
    # one row a part, of which there are as many as shuffle partitions: the first and last page of those that are not empty
    ends = sorted(ordered.groupBy("part").agg(F.min(F.struct(*keys))["row"].alias("first"), F.max(F.struct(*keys))["row"].alias("last")).collect())
    pairs = [(after.part, before.last) for before, after in zip(ends, ends[1:])] + [(before.part, after.first) for before, after in zip(ends, ends[1:])]
    spark = found.sparkSession
    lent = ordered.drop("part").join(F.broadcast(spark.createDataFrame(pairs, "part int, row long")), "row").select("part", *keys, "same", "hashes", F.lit(True).alias("lent"))
    every = ordered.select("part", *keys, "same", "hashes", F.lit(False).alias("lent")).unionByName(lent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = held = None
        for page in (row for batch in batches for row in batch.to_pylist()):
            if held is not None and (got := _gone(held, before, page)):
                yield got
            before, held = (held, page) if held is None or held["part"] == page["part"] else (None, page)
        if held is not None and (got := _gone(held, before, None)):
            yield got

    return every.repartition(parts, "part").sortWithinPartitions("part", *keys).mapInArrow(run, "host string, same long, gone array<boolean>")


def _common(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _gone(page: dict, before: dict | None, after: dict | None) -> pa.RecordBatch | None:
    """The row of a page that shares lines with its neighbour in its own host and part."""
    if page["lent"]:
        return None
    near = [p for p in (before, after) if p is not None and p["part"] == page["part"] and p["host"] == page["host"]]
    if not near:
        return None
    nearest = max(near, key=lambda p: _common(p["path"], page["path"]))
    found = shared(np.array(page["hashes"], np.int64), np.array(nearest["hashes"], np.int64))
    return pa.RecordBatch.from_arrays([pa.array([page["host"]], pa.string()), pa.array([page["same"]], pa.int64()), pa.array([found.tolist()], pa.list_(pa.bool_()))], names=["host", "same", "gone"]) if found.any() else None
