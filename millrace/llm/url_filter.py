"""URL rules, with blocks carried along redirect and canonical-link edges. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import UPPER, cut, join_split
from millrace.llm.components import connected_components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; all empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    part = lambda group: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)([^#]*)", group), F.lit(""))
    return F.translate(part(1), UPPER, UPPER.lower()), part(2), part(3)


def best_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    other = F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*'([^']*)'""", 1)
    bare = F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*([^\s"'>]+)""", 1)
    return reduce(lambda a, b: F.when(a != "", a).otherwise(b), (quoted, other, bare))


def links(pages: DataFrame) -> DataFrame:
    """(a, b): the address of a page and the one that its canonical link or its refresh redirect names.

    An address is host, path and query: scheme and fragment name the same page.
    """
    html = F.col("html")
    canonical = F.regexp_extract(html, r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0)
    refresh = F.regexp_extract(html, r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0)
    moved = F.regexp_extract(_attribute(refresh, "content"), r"""(?i)\burl\s*=\s*["']?([^"']+)""", 1)
    host, path, query = split_url(F.col("url"))
    found = pages.where("url is not null and html is not null").select(
        host.alias("host"), path.alias("path"), F.concat(host, path, query).alias("a"),
        F.explode(F.array(_attribute(canonical, "href"), moved)).alias("target"),
    ).where("target <> '' and host <> ''")
    target = F.trim(F.replace(F.col("target"), F.lit("&amp;"), F.lit("&")))
    folder = F.regexp_extract("path", r"^(.*/)?", 0)
    absolute = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(F.lit("x://"), F.col("host"), target))
        .otherwise(F.concat(F.lit("x://"), F.col("host"), F.when(folder == "", "/").otherwise(folder), target))
    )
    return found.select("a", F.concat(*split_url(absolute)).alias("b"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    The longest fitting rule of a url decides: an explicit allow or block of its own always wins. A url that no rule
    fits is blocked if its component over the ``edges`` (a, b) of addresses holds an address that a rule blocks, else
    allowed. Without ``edges`` these are the pages' canonical links and refresh redirects. Addresses that are no page
    of the table count as members as well.

    A url that is null or has no ``://`` has empty host and path; such urls are allowed and link with nothing, as do
    rows without html. Repeated rows get a row each; an empty table gives an empty result.
    """
    edges = cut(links(pages) if edges is None else edges, "url-links")
    host, path, query = split_url(F.col("url"))
    name, verdict = best_rule(rules, F.col("host"), F.col("path"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), F.concat(host, path, query).alias("id"))
    judged = judged.select("page_id", "host", "path", "id", name.alias("rule"), verdict.alias("verdict"))
    if edges.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    members = cut(connected_components(edges), "url-components")
    node_host, node_path, _ = split_url(F.concat(F.lit("x://"), F.col("id")))
    _, node_verdict = best_rule(rules, node_host, node_path)
    bad = members.where(node_verdict == "block").select("component").distinct()
    aliases = join_split(members, bad, ["component"], "left_semi").select("id", F.lit(True).alias("tainted"))
    inherited = F.when(F.col("tainted"), "block").otherwise("allow")
    return join_split(judged, aliases, ["id"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", inherited).alias("verdict")
    )
