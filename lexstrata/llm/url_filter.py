"""URL filters with redirect equivalence.

Rules (verdict, host, path) fit their host and all its subdomains where the url's path
starts with the rule's; the longest (then the longest host) wins.  Pages, their
canonical links and redirects (``meta refresh`` in the page, or rows of ``redirects``)
form a graph of urls without fragment and scheme; block decisions spread over its
connected components.  A url's own rule, an explicit allow above all, comes first; then a
block from an alias; otherwise the url is allowed.

The graph holds only pages that declare an alias.  Rules are a parameter list: a few become
one expression; more than ``EXPRESSION_RULES`` become a table that is joined with the
host's suffixes and the path's prefixes of the lengths that rules have.

Defined cases: null url or one without ``://`` has empty host and path, no rule, no
alias; null html has no links; repeated rows are judged each on their own; a link to the
page itself says nothing; links are unescaped and, if relative, resolved (``?query``,
``../``) before they are compared; further columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import connected
from .scratch import Scratch

EXPRESSION_RULES = 500
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ATTR = r"""\s*=\s*["']?\s*"""
_CANONICAL = (
    rf"""(?i)<link\s[^>]*?\brel{_ATTR}canonical\b[^>]*?\bhref{_ATTR}([^"'\s>]+)""",
    rf"""(?i)<link\s[^>]*?\bhref{_ATTR}([^"'\s>]+)[^>]*?\brel{_ATTR}canonical\b""",
)
_REFRESH = (
    rf"""(?i)<meta\s[^>]*?\bhttp-equiv{_ATTR}refresh\b[^>]*?\bcontent{_ATTR}[^>]*?\burl\s*=\s*['"]?([^"'\s>]+)""",
    rf"""(?i)<meta\s[^>]*?\bcontent{_ATTR}[^>"']*?\burl\s*=\s*['"]?([^"'\s>]+)[^>]*?\bhttp-equiv{_ATTR}refresh\b""",
)

_REFERENCE = re.compile(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)")
_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path and query; null where there is no host."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(F.lit("x://"), host_of(url), rest))


_DECISION = "struct<rule:string,verdict:string>"


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the rule that decides, or null."""
    found = F.lit(None).cast(_DECISION)
    for verdict, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(at + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def with_rule(rows: DataFrame, rules: list[tuple[str, str, str]], tmp: Scratch, name: str) -> DataFrame:
    """``rows`` (host, path, ..) with ``own``, the rule that decides each."""
    if len(rules) <= EXPRESSION_RULES:
        return rows.withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    spark = rows.sparkSession
    ranked = [(len(h + p), len(h), i, v, h, p) for i, (v, h, p) in enumerate(rules)]
    table = spark.createDataFrame(ranked, "size int, host_size int, i int, verdict string, at string, prefix string")
    table = tmp.save(table.repartition(max(1, len(rules) // 100_000)), f"{name}-rules")
    lengths = F.array(*(F.lit(n) for n in sorted({len(p) for _, _, p in rules})))
    names = tmp.save(rows.select("host", "path").distinct(), f"{name}-names")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    starts = F.transform(F.filter(lengths, lambda n: n <= F.char_length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = names.select("host", "path", F.explode(suffixes).alias("at"), starts.alias("starts")).select("host", "path", "at", F.explode("starts").alias("prefix"))
    best = tried.join(table, ["at", "prefix"]).groupBy("host", "path").agg(F.max(F.struct("size", "host_size", "i", F.concat("at", "prefix").alias("rule"), "verdict")).alias("b"))
    best = tmp.save(best.select("host", "path", F.struct("b.rule", "b.verdict").alias("own")), f"{name}-best")
    return rows.join(best, ["host", "path"], "left")


def _links(html: Column) -> Column:
    """Targets of canonical links and refreshes in a page."""
    none = F.array().cast("array<string>")
    every = F.concat(*(F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (*_CANONICAL, *_REFRESH)))
    return F.when(html.rlike(r"(?i)\bcanonical\b|\brefresh\b"), every).otherwise(none)


def _unescape(text: str) -> str:
    """Character references as in an attribute: a name without semicolon stands for itself before ``=``."""

    def one(m: re.Match) -> str:
        name = m[1]
        if name.startswith("#"):
            return unescape(m[0])
        if not name.endswith(";") and text[m.end() : m.end() + 1] == "=":
            return m[0]
        return html5.get(name, m[0])

    return _REFERENCE.sub(one, text)


def _absolute(link: str, url: str | None) -> str | None:
    """A link as written in the page at ``url``, resolved; null for what isn't an address."""
    link = _unescape(link).strip()
    if _ADDRESS.match(link):
        return link
    try:
        return urljoin(url, link) if url and link else None
    except ValueError:  # brackets that hold no IPv6 address
        return None


def _targets(batches):
    """(url, link) -> (a, b): the page and what it links to."""
    for batch in batches:
        urls, links = (batch.column(i).to_pylist() for i in range(2))
        b = [_absolute(x, u) for u, x in zip(urls, links, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(b, pa.string())], names=["a", "b"])


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, via (``rule``, ``alias`` or ``default``).

    ``redirects``: optional rows (from_url, to_url).
    """
    tmp = Scratch(pages.sparkSession, "urls")
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    rows = pages.select("page_id", url.alias("url"), html.alias("html"))
    links = rows.select("url", F.explode(_links(F.col("html"))).alias("link")).mapInArrow(_targets, "a string, b string")
    if redirects is not None:
        links = links.union(redirects.select(F.col("from_url").cast("string").alias("a"), F.col("to_url").cast("string").alias("b")))
    edges = tmp.save(links.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")).where("a is not null and b is not null and a != b").distinct(), "aliases")
    rows = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = with_rule(rows, rules, tmp, "pages")
    blocked = F.lit(False)
    if not edges.isEmpty():
        labels = connected(edges, tmp)
        state = labels.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
        state = with_rule(state, rules, tmp, "nodes").select("node", "component", F.col("own.verdict").alias("v"))
        bad = state.groupBy("component").agg(F.max(F.coalesce(F.col("v") == "block", F.lit(False))).alias("blocked"))
        spread = tmp.save(state.join(bad, "component").where("blocked").select(F.col("node"), "blocked"), "blocked")
        rows = rows.withColumn("node", node_of(F.col("url"))).join(spread, "node", "left")
        blocked = F.coalesce("blocked", F.lit(False))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.when(F.col("own").isNotNull(), F.col("own.verdict")).when(blocked, "block").otherwise("allow").alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(blocked, "alias").otherwise("default").alias("via"),
    )


K.ship(__name__)
