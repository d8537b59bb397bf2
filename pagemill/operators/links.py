"""Link edges: extraction, scope, newness and reachability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.binding import bind, literal, over
from pagemill.functions.html import link_references
from pagemill.functions.urls import (
    canonical_sql,
    domain_sql,
    escape_sql,
    path_sql,
    resolve_sql,
    url_domain,
    url_matches,
)
from pagemill.session import cut_lineage, drop_checkpoint, kept_by

# Path endings a crawl does not follow.
IGNORED_EXTENSIONS = (
    # archives
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    # images
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff", "ai",
    "drw", "dxf", "eps", "ps", "svg", "cdr", "ico", "webp",
    # audio
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    # video
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a", "m4v",
    "flv", "webm",
    # office documents
    "xls", "xlsm", "xlsx", "xltm", "xltx", "potm", "potx", "ppt", "pptm", "pptx", "pps",
    "doc", "docb", "docm", "docx", "dotm", "dotx", "odt", "ods", "odg", "odp",
    # other
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb", "js", "hta",
    "bat", "cpl", "msi", "msp", "py",
)


_LEVELS_PER_CUT = 16
#: Edges that a partition may hold, and the number of sources that may have a large share of all.
_EDGES_PER_PART = 1_000_000
_LARGE_SOURCES = 1_000


def page_links(
    url: Column, content: Column, ignored_extensions: Sequence[str] = IGNORED_EXTENSIONS
) -> Column:
    """The links of a page as an array of ``link_url, target_url, link_domain, path``.

    ``link_url`` is absolute and percent-encoded, ``target_url`` its canonical form; a page
    names each link once.  Only URLs with an authority are links.  Links are built and
    judged inside their page, before they become rows: a filter on the rows would make the
    optimizer repeat the whole expression for every condition.
    """
    endings = "|".join(extension.replace(".", r"\.") for extension in ignored_extensions)
    ignored = literal(rf"\.(?:{endings})$")
    base = f"if(f.links.base IS NULL, f.url, {resolve_sql('f.url', 'f.links.base')})"
    link = bind(
        "link",
        escape_sql(resolve_sql("home", "href")),
        f"""named_struct('link_url', link, 'target_url', {canonical_sql("link")},
            'link_domain', {domain_sql("link")}, 'path', lower({path_sql("link")}))""",
    )
    kept = "edge -> edge.link_url RLIKE '^(?i:https?|ftp|file)://'"
    if ignored_extensions:
        kept += f" AND NOT edge.path RLIKE {ignored}"
    edges = bind(
        "home",
        base,
        f"filter(transform(array_distinct(f.links.links), href -> {link}), {kept})",
    )
    found = F.struct(url.alias("url"), link_references(content).alias("links"))
    return over(found, "f", edges)


def scoped_links(
    links: Column, url: Column, url_filter: str | Sequence[str] | None = None, domain: str | None = None
) -> Column:
    """Of :func:`page_links` the targets on the given host, by default that of the page's ``url``."""
    patterns = [url_filter] if isinstance(url_filter, str) else list(url_filter or ())
    found = " OR ".join(f"edge.link_url RLIKE {literal(pattern)}" for pattern in patterns) or "true"
    home = url_domain(F.lit(domain) if domain is not None else url)
    return over(
        F.struct(links.alias("links"), home.alias("home")),
        "f",
        f"""transform(filter(f.links, edge -> edge.link_domain = f.home AND ({found})),
            edge -> edge.target_url)""",
    )


def link_edges(
    pages: DataFrame, ignored_extensions: Sequence[str] = IGNORED_EXTENSIONS
) -> DataFrame:
    """``seq, source_url, link_url, target_url, link_domain`` of the links of pages with
    ``content``, as :func:`page_links` finds them.
    """
    links = page_links(F.col("url"), F.col("content"), ignored_extensions)
    return pages.select(
        "seq", F.col("url").alias("source_url"), F.explode(links).alias("edge")
    ).select("seq", "source_url", "edge.link_url", "edge.target_url", "edge.link_domain")


def links_in_scope(
    edges: DataFrame,
    url_filter: str | Sequence[str] | None = None,
    domain: str | None = None,
) -> DataFrame:
    """Edges to exactly the given host, by default the host of the linking page."""
    home = url_domain(F.lit(domain) if domain is not None else F.col("source_url"))
    return edges.where(
        (F.col("link_domain") == home) & url_matches(F.col("link_url"), url_filter)
    )


def first_links(edges: DataFrame) -> DataFrame:
    """``target_url, source_url, seq``: each target once, with the first page that named it."""
    first = F.min_by(F.struct("seq", "source_url"), "seq")
    return (
        edges.groupBy("target_url")
        .agg(first.alias("_first"))
        .select("target_url", F.col("_first")["source_url"].alias("source_url"), F.col("_first")["seq"].alias("seq"))
    )


def new_links(edges: DataFrame, known: DataFrame) -> DataFrame:
    """First links to targets that ``known`` (column ``url``, canonical) does not hold.

    Targets are reduced to one row before the anti-join, so a target most pages link to
    costs no more there than any other.
    """
    return first_links(edges).join(
        known.select(F.col("url").alias("target_url")), "target_url", "left_anti"
    )


def crawl_depth(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``url, depth``: the least number of links from any seed (column ``url``).

    Semi-naive: only the last level meets the edges.  Edges are stored partitioned by their
    source, what is reached by its URL, and both stay where they are; a level shuffles itself
    and its targets.  Sources with a large share of the edges are split by target.  Levels are
    checkpoints, so the plan stays small and a lost executor does not replay earlier ones.
    """
    plain = cut_lineage(edges.select("source_url", "target_url").where("source_url IS NOT NULL").distinct())
    total = plain.count()
    parts = max(int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // _EDGES_PER_PART))
    large = max(_EDGES_PER_PART // 10, total // _LARGE_SOURCES)
    hot = cut_lineage(
        plain.groupBy("source_url").agg(F.count("*").alias("rows")).where(F.col("rows") > large).select(
            "source_url", F.ceil(F.col("rows") / large).cast("int").alias("salts")
        )
    )
    # At most _LARGE_SOURCES sources have that many edges, so the hint is bounded.
    salted = plain.join(F.broadcast(hot), "source_url", "left").select(
        "source_url",
        "target_url",
        F.coalesce(F.pmod(F.xxhash64("target_url"), "salts").cast("int"), F.lit(0)).alias("salt"),
    )
    kept = kept_by(salted, parts, "source_url", "salt")
    drop_checkpoint(plain)
    level = kept_by(seeds.select("url").distinct().withColumn("depth", F.lit(0)), parts, "url")
    reached, spent, depth = level, [level], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        level = kept_by(next_level(level, kept, hot, reached, parts, depth), parts, "url")
        if level.isEmpty():
            drop_checkpoint(level)
            break
        spent.append(level)
        reached = reached.unionByName(level)
        if depth % _LEVELS_PER_CUT == 0:
            reached = kept_by(reached, parts, "url")
            for old in spent[:-1]:
                drop_checkpoint(old)
            spent = [level, reached]
    drop_checkpoint(kept)
    return reached


def next_level(
    level: DataFrame, kept: DataFrame, hot: DataFrame, reached: DataFrame, parts: int, depth: int
) -> DataFrame:
    """``url, depth`` of the targets of ``level`` that are not reached yet."""
    sources = (
        level.select(F.col("url").alias("source_url"))
        .join(F.broadcast(hot), "source_url", "left")
        .select("source_url", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    )
    targets = kept.join(sources, ["source_url", "salt"], "left_semi").select(F.col("target_url").alias("url"))
    once = targets.repartition(parts, "url").distinct()
    return once.join(reached.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth))
