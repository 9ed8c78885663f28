"""URL filter with redirect equivalence: blocks reach every alias of a blocked url.

Rules name a host and a path prefix. Urls that redirect to each other, or name each other as canonical,
are one page under several names; the components of these links are the equivalence classes. A url
without a rule of its own is blocked if any url of its class is; a rule of its own always wins, so an
explicit allow is never overruled by a block elsewhere in the class. All else is allowed.

Everything is built-in functions and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ascii_lower
from barlake.llm.components import components

_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)"
_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*["']?\s*canonical\b"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_GOES_TO = r"""(?i)\burl\s*=\s*['"]?([^"'>]*)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    """Host in lower case (A-Z); empty for null and for texts without ``://``."""
    return ascii_lower(_part(url, 2))


def path_of(url: Column) -> Column:
    return _part(url, 3)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``(size, rule, verdict)`` of the longest rule that fits, null if none does.

    Rules of equal text: block wins. The rules are a policy of bounded size and part of the plan; a
    url looks up each suffix of its host in one map, so its cost does not grow with their number.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    known = F.create_map(*(
        part for name, own in by_host.items() for part in (
            F.lit(name),
            F.array(*(
                F.struct(
                    F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
                    F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path"),
                ) for r in own
            )),
        )
    ))
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: known[s]), lambda r: r.isNotNull()))
    fitting = F.filter(found, lambda r: F.startswith(path, r["path"]))
    best = F.array_max(F.transform(
        fitting, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))
    ))
    return best


def with_parts(frame: DataFrame, url: str, prefix: str) -> DataFrame:
    """Adds scheme, host, path, query and key of a url, each behind ``prefix``.

    The key names a page: host, path and query. Scheme and fragment do not tell pages apart. It is
    null if there is no host. Columns of their own keep the parse from being repeated for each use.
    """
    column = F.col(url)
    frame = frame.withColumns({
        f"{prefix}scheme": _part(column, 1), f"{prefix}host": host_of(column),
        f"{prefix}path": path_of(column), f"{prefix}query": _part(column, 4),
    })
    host, path, query = (F.col(prefix + name) for name in ("host", "path", "query"))
    key = F.concat(host, F.when(path == "", "/").otherwise(path), query)
    return frame.withColumn(f"{prefix}key", F.when(host != "", key))


def resolved(link: Column, base: str) -> Column:
    """Absolute form of a link found on a page with the parts ``base``; null if it leads to no page.
    ``..`` stays."""
    path = F.col(f"{base}path")
    scheme, site = F.col(f"{base}scheme"), F.concat(F.col(f"{base}scheme"), F.lit("://"), F.col(f"{base}host"))
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (
        F.when(link.isNull() | (link == "") | F.startswith(link, F.lit("#")), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, path, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(source, target)`` urls of canonical links and refresh redirects in the pages' html."""
    tags = F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0)))
    found = pages.select(F.col("url").alias("source"), tags.alias("tag"))
    tag = F.col("tag")
    target = F.when(
        tag.rlike(_CANONICAL), F.concat(*(F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)))
    ).when(tag.rlike(_REFRESH), F.regexp_extract(tag, _GOES_TO, 1))
    links = found.withColumn("link", F.replace(F.trim(target), F.lit("&amp;"), F.lit("&")))
    links = with_parts(links.where(F.coalesce(F.col("link"), F.lit("")) != ""), "source", "s_")
    return links.select("source", resolved(F.col("link"), "s_").alias("target"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None,
) -> DataFrame:
    """``pages(page_id, url, html)`` with host, path, rule, verdict and the class the url belongs to.

    ``redirects(source, target)`` adds links seen elsewhere, such as a crawl log's. One row per input
    row; ``alias_class`` is the smallest page key of the class, null for urls without links, and
    ``propagated`` tells blocks that came through the class. Other columns are ignored. A null url,
    or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated pages
    are judged alike.

    The html is scanned once, and only the links leave that scan.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "url-filter")
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    # Stored before the filters below, which would repeat the parse of both urls for every use.
    links = scratch.save(links, "found")
    edges = with_parts(with_parts(links, "source", "s_"), "target", "t_")
    edges = edges.select(F.col("s_key").alias("a"), F.col("t_key").alias("b"))
    edges = scratch.save(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    classes = scratch.save(components(edges, scratch), "classes")

    # A key has no scheme of its own.
    nodes = with_parts(classes.withColumn("url", F.concat(F.lit("http://"), F.col("node"))), "url", "")
    named = best_rule(F.col("host"), F.col("path"), rules)["verdict"]
    blocked = nodes.groupBy("root").agg(F.bool_or(named == "block").alias("bad"))
    aliases = classes.join(blocked, "root").select(
        F.col("node").alias("key"), F.col("root").alias("alias_class"), "bad"
    )

    parsed = with_parts(pages.select("page_id", "url"), "url", "").select("page_id", "host", "path", "key")
    ruled = parsed.withColumn("_best", best_rule(F.col("host"), F.col("path"), rules))
    own, bad = F.col("_best.verdict"), F.coalesce(F.col("bad"), F.lit(False))
    return ruled.join(aliases, "key", "left").select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(own, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "alias_class", (own.isNull() & bad).alias("propagated"),
    )
