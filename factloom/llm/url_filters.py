"""URL filters: rules by host and path, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, materialise


class Rule(NamedTuple):
    """A host (with all its subdomains), the start of a path, and what happens to URLs that fit both."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>;]*;\s*url\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], give: str) -> Column:
    """The text or the verdict of the longest rule that fits, else null; of two as long the allowing one."""
    out = None
    for rule in sorted(set(rules), key=lambda r: (-len(r.text), r.verdict != "allow", r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, getattr(rule, give)) if out is None else out.when(fits, getattr(rule, give))
    return F.lit(None).cast("string") if out is None else out


def key(url: Column) -> Column:
    """What tells a page: host, path and query, without scheme and fragment; null without ://."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): keys of pages and of what they redirect to (meta refresh) or name as canonical, outside comments, scripts and styles; targets may be relative."""
    html, url = F.regexp_replace(F.col("html").cast("string"), _HIDDEN, " "), F.col("url").cast("string")
    named = pages.where(F.col("html").rlike("(?i)canonical|refresh")).select(url.alias("url"), F.concat(F.regexp_extract_all(html, F.lit(_CANONICAL)), F.regexp_extract_all(html, F.lit(_REFRESH))).alias("targets"))
    target = F.replace("target", F.lit("&amp;"), F.lit("&"))
    site = F.regexp_extract("url", r"^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"^(.*?://[^/?#]*/(?:[^?#]*/)?)", 1)
    full = F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(target.startswith("//"), F.concat(F.lit("http:"), target)).when(target.startswith("/"), F.concat(site, target)).when(folder == "", F.concat(site, F.lit("/"), target)).otherwise(F.concat(folder, target))
    return named.select("url", F.explode("targets").alias("target")).select(key(F.col("url")).alias("a"), key(full).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row a page: host, path, the rule that fits (else null), the verdict, and how it came about.

    A rule's own verdict stands. A page without one takes that of its aliases,
    the connected component over redirects and canonical links: allow if a rule
    allows any of them, else block if one blocks any, else allow. All of it are
    DataFrame operations; only pages with such links take part in joins.

    Null URLs and those without :// have an empty host and path and no aliases.
    Repeated rows are judged each for itself; an empty table gives no rows;
    further columns are ignored. rules: a short list, part of the plan.
    """
    url = F.col("url").cast("string")
    judged = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), key(url).alias("page_key"))
    judged = judged.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules, "text").alias("rule"), rule_of(F.col("host"), F.col("path"), rules, "verdict").alias("own"), "page_key")
    edges = materialise(alias_edges(pages))
    if edges.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"), F.when(F.col("own").isNotNull(), "rule").otherwise("default").alias("reason"))
    labels = components(edges)
    node = F.concat(F.lit("://"), F.col("node"))
    decided = labels.withColumn("own", rule_of(host(node), path(node), rules, "verdict")).groupBy("label").agg(F.when(F.max(F.col("own") == "allow"), "allow").when(F.max(F.col("own") == "block"), "block").alias("group"))
    known = labels.join(materialise(decided), "label").select(F.col("node").alias("page_key"), "group")
    return judged.join(known, "page_key", "left").select("page_id", "host", "path", "rule", F.coalesce("own", "group", F.lit("allow")).alias("verdict"), F.when(F.col("own").isNotNull(), "rule").when(F.col("group").isNotNull(), "alias").otherwise("default").alias("reason"))


def _sql_rule(give: str) -> str:
    cases = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, give)}'" for r in sorted(RULES, key=lambda r: (-len(r.text), r.verdict != "allow", r))]
    return f"CASE {' '.join(cases)} END"


def _sql_place(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '') AS path"


def _sql_key(url: str) -> str:
    return f"CASE WHEN contains({url}, '://') THEN translate(regexp_extract({url}, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') || regexp_extract({url}, '://[^/?#]*([^#]*)', 1) END"


#: The same over absolute targets: DuckDB's patterns have no look-ahead, so link and meta elements are cut out first.
ORACLE = rf"""
WITH RECURSIVE elements AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '{_HIDDEN.removeprefix("(?is)")}', ' ', 'gis'), '(?is)<(?:link|meta)\b[^>]*>')) AS e FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh')),
targets AS (
  SELECT url, CASE WHEN regexp_matches(e, '(?is)^<link.*rel\s*=\s*["'']?[^"''>]*\bcanonical\b') THEN regexp_extract(e, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(e, '(?is)^<meta.*http-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(e, '(?is)\bcontent\s*=\s*["'']?[^"''>;]*;\s*url\s*=\s*["'']?([^"''\s>]+)', 1) END AS t FROM elements),
links AS (SELECT {_sql_key("url")} AS a, {_sql_key("replace(t, '&amp;', '&')")} AS b FROM targets WHERE contains(t, '://')),
edges AS (SELECT a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT a AS start, a AS node FROM edges UNION SELECT r.start, e.b FROM reach r JOIN edges e ON r.node = e.a),
verdicts AS (SELECT start, {_sql_rule("verdict")} AS own FROM (SELECT start, {_sql_place("'://' || node")} FROM reach)),
groups AS (SELECT start, CASE WHEN bool_or(own = 'allow') THEN 'allow' WHEN bool_or(own = 'block') THEN 'block' END AS grp FROM verdicts GROUP BY start),
placed AS (SELECT page_id, {_sql_place("url")}, {_sql_key("url")} AS k FROM pages),
ruled AS (SELECT *, {_sql_rule("text")} AS rule, {_sql_rule("verdict")} AS own FROM placed)
SELECT page_id, host, path, rule, coalesce(own, grp, 'allow') AS verdict,
  CASE WHEN own IS NOT NULL THEN 'rule' WHEN grp IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM ruled LEFT JOIN groups ON k = start
"""
