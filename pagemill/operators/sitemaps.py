"""Robots files and sitemaps as sources of links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.urls import canonical_url, resolve_url, url_domain, url_matches
from pagemill.operators.links import crawl_depth

_SITEMAP_SCHEMA = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"


def robots_sitemaps(robots: DataFrame, domain: str | None = None) -> DataFrame:
    """``source_url, sitemap_url`` from the ``Sitemap:`` lines of good robots responses.

    Only sitemaps on the given host, by default that of the robots file, count.
    """
    lines = robots.where(F.col("status") < 400).select(
        "seq", "url", F.explode(F.split("content", r"\r\n|[\n\r\x0B\f\x{85}]")).alias("line")
    )
    named = lines.where(F.col("line").rlike(r"(?i)^\s*sitemap:")).withColumn(
        "_reference", F.btrim(F.regexp_replace("line", r"^[^:]*:", ""), F.lit(" \t"))
    )
    resolved = named.withColumn("_resolved", resolve_url(F.col("url"), F.col("_reference")))
    return _on_host(resolved, domain)


def _on_host(resolved: DataFrame, domain: str | None) -> DataFrame:
    home = url_domain(F.lit(domain) if domain is not None else F.col("url"))
    return (
        resolved.where(url_domain(F.col("_resolved")) == home)
        .select(
            "seq", F.col("url").alias("source_url"), canonical_url(F.col("_resolved")).alias("sitemap_url")
        )
        .distinct()
    )


def parsed_sitemaps(responses: DataFrame) -> DataFrame:
    """``seq, url, urls, sitemaps`` of good responses that hold a sitemap.

    Failed, empty and malformed ones yield no row.
    """
    parsed = F.from_xml(F.col("content"), _SITEMAP_SCHEMA, {"mode": "PERMISSIVE"})
    return (
        responses.where(F.col("status") < 400)
        .select("seq", "url", parsed.alias("_parsed"))
        .select(
            "seq",
            "url",
            F.col("_parsed.url.loc").alias("urls"),
            F.col("_parsed.sitemap.loc").alias("sitemaps"),
        )
        .where(F.col("urls").isNotNull() | F.col("sitemaps").isNotNull())
    )


def sitemap_children(parsed: DataFrame, domain: str | None = None) -> DataFrame:
    """``seq, source_url, sitemap_url`` of the entries of sitemap indexes on the same host."""
    children = parsed.select("seq", "url", F.explode("sitemaps").alias("_resolved"))
    return _on_host(children.where(F.col("_resolved").isNotNull()), domain)


def sitemap_urls(
    parsed: DataFrame,
    url_filter: str | Sequence[str] | None = None,
    domain: str | None = None,
) -> DataFrame:
    """Link edges from URL sets, shaped like those of pages: same host, URL filter."""
    entries = parsed.select("seq", F.col("url").alias("source_url"), F.explode("urls").alias("_loc"))
    links = entries.where(F.col("_loc").isNotNull()).select(
        "seq", "source_url", F.btrim("_loc").alias("link_url"), canonical_url(F.col("_loc")).alias("target_url")
    )
    home = url_domain(F.lit(domain) if domain is not None else F.col("source_url"))
    return links.where(
        (url_domain(F.col("target_url")) == home) & url_matches(F.col("target_url"), url_filter)
    )


def reachable_sitemaps(children: DataFrame, seeds: DataFrame) -> DataFrame:
    """``url, depth`` of the sitemaps that indexes lead to from the seeds (column ``url``)."""
    edges = children.select("source_url", F.col("sitemap_url").alias("target_url"))
    return crawl_depth(edges, seeds)
