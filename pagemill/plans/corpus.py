"""Inputs of the registered queries, derived row by row from the given tables.

``pages`` holds only an id, a URL and HTML.  Status, headers, redirects, images, failures
and stored URL states are added here to every row by rule; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.html import link_references
from pagemill.functions.urls import url_origin
from pagemill.operators.frontier import frontier_rows
from pagemill.operators.records import iso_utc
from pagemill.sources.responses import response_documents, spread, with_content

# The derived attributes, by remainder of the page id.
CONTENT_TYPES = (
    "text/html; charset=utf-8",
    "TEXT/HTML",
    "text/plain",
    "application/xml",
    "application/json",
    "application/octet-stream",
)
MARKUP = (
    '<img src="/img/{id}.png" alt="Image &amp; {id}">',
    '<img src="data:image/png;base64,AAAA" alt="Inline"><IMG SRC=\'/b/{id}.jpg\'>',
    '<nav><img src="/nav.png" alt="Nav"></nav><img src=/plain.gif alt>',
    '<p style="color: red"  class="x">note</p>\n  <link rel="stylesheet" href="/s.css">',
)
FIRST_FETCH = 1767225600
STATUSES = ("pending", "failed", "skipped", "done")
SEED_STAMP = "2026-01-01T00:00:00Z"
SITEMAP_SEQ, ROBOTS_SEQ = 10**12, 2 * 10**12


def by_remainder(number: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as captured responses."""
    pages = spread(table(spark, sf_dir, "pages"))
    number = F.col("page_id")
    refused = number % 29 == 0
    extra = F.replace(by_remainder(number, MARKUP), F.lit("{id}"), number.cast("string"))
    old = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/old"))
    redirected = number % 10 == 0
    return pages.select(
        number.alias("seq"),
        F.when(redirected, old).otherwise(F.col("url")).alias("request_url"),
        "url",
        F.when(redirected, F.array(old, F.concat(old, F.lit("#top"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("redirect_urls"),
        F.when(refused, None)
        .when(number % 17 == 0, 404)
        .when(number % 23 == 0, 500)
        .otherwise(200)
        .cast("int")
        .alias("status"),
        F.create_map(
            F.lit("Content-Type"), by_remainder(number, CONTENT_TYPES),
            F.lit("X-Page"), number.cast("string"),
        ).alias("headers"),
        F.replace("html", F.lit("</article>"), F.concat(extra, F.lit("</article>")))
        .cast("binary")
        .alias("body"),
        F.when(refused, "connection refused").alias("error"),
        F.when(refused, "ConnectionRefusedError").alias("failure_type"),
        F.timestamp_seconds(F.lit(FIRST_FETCH) + number).alias("fetched_at"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_documents(responses(spark, sf_dir))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with decoded ``content``."""
    return with_content(documents(spark, sf_dir))


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored frontier with two spellings of every page URL in different states."""
    pages = table(spark, sf_dir, "pages")
    number = F.col("page_id")
    spellings = F.array(
        F.struct(F.col("url"), by_remainder(number, STATUSES).alias("status")),
        F.struct(
            F.concat("url", F.lit("#main")).alias("url"),
            by_remainder(F.floor(number / 4), STATUSES).alias("status"),
        ),
    )
    rows = pages.select(
        "page_id", F.col("url").alias("page_url"), F.explode(spellings).alias("s")
    ).select("page_id", F.col("s.url").alias("url"), F.col("s.status").alias("status"))
    rows = rows.withColumn("source_url", F.concat(url_origin(F.col("url")), F.lit("/")))
    stamped = frontier_rows(
        rows.withColumn("http_status", F.when(F.col("status") == "failed", F.lit(503))),
        iso_utc(F.timestamp_seconds(F.lit(FIRST_FETCH) - F.col("page_id"))),
    )
    return stamped


def sitemap_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, url, status, content``: for every page one sitemap of its own.

    By remainder of the id it is an index of sitemaps, a broken file, or a URL set with the
    page and its links.
    """
    pages = spread(table(spark, sf_dir, "pages"))
    number = F.col("page_id")
    origin = url_origin(F.col("url"))

    def escaped(value: Column) -> Column:
        return F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def entry(name: str, loc: Column) -> Column:
        return F.concat(F.lit(f"<{name}><loc> "), escaped(loc), F.lit(f"</loc></{name}>"))

    def sitemap(step: int) -> Column:
        return F.concat(origin, F.lit("/sitemap-"), (number + step).cast("string"), F.lit(".xml"))

    namespace = ' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    links = F.array_join(
        F.transform(link_references(F.col("html"))["links"], lambda href: entry("url", F.concat(origin, href))),
        "",
    )
    outside = F.lit("https://other.example.com/external")
    urlset = F.concat(
        F.lit(f"<urlset{namespace}>"), entry("url", F.col("url")), links, entry("url", outside)
    )
    index = F.concat(
        F.lit(f"<sitemapindex{namespace}>"),
        entry("sitemap", sitemap(1)),
        entry("sitemap", sitemap(5)),
        entry("sitemap", outside),
        F.lit("</sitemapindex>"),
    )
    return pages.select(
        number.alias("seq"),
        sitemap(0).alias("url"),
        F.when(number % 13 == 0, 404).otherwise(200).alias("status"),
        F.when(number % 11 == 0, "")
        .when(number % 5 == 0, index)
        .when(number % 5 == 1, urlset)
        .otherwise(F.concat(urlset, F.lit("</urlset>")))
        .alias("content"),
    )


def robots_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq, url, status, content``: a robots file per page with three sitemap lines."""
    pages = table(spark, sf_dir, "pages")
    number = F.col("page_id")
    lines = F.concat(
        F.lit("User-agent: *\nDisallow: /private\n  SITEMAP:  /maps/"),
        number.cast("string"),
        F.lit(".xml \r\nSitemap: "),
        F.upper(url_origin(F.col("url"))),
        F.lit("/sitemap.xml\nSitemap: https://other.example.com/sitemap.xml\nsitemap"),
    )
    return pages.select(
        number.alias("seq"),
        F.concat(url_origin(F.col("url")), F.lit("/robots.txt")).alias("url"),
        F.when(number % 13 == 0, 404).otherwise(200).alias("status"),
        lines.alias("content"),
    )


def captured_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemaps of all pages, and robots files that name them, as captured responses."""
    maps = sitemap_responses(spark, sf_dir)
    robots = maps.select(
        (F.col("seq") + ROBOTS_SEQ).alias("seq"),
        F.concat(url_origin(F.col("url")), F.lit("/robots.txt")).alias("url"),
        F.lit(200).alias("status"),
        F.lit("text/plain").alias("kind"),
        F.concat(F.lit("User-agent: *\nSitemap: "), "url").alias("content"),
    )
    maps = maps.select((F.col("seq") + SITEMAP_SEQ).alias("seq"), "url", "status", F.lit("text/xml").alias("kind"), "content")
    return maps.unionByName(robots).select(
        "seq",
        F.col("url").alias("request_url"),
        "url",
        F.array().cast("array<string>").alias("redirect_urls"),
        F.col("status").cast("int").alias("status"),
        F.create_map(F.lit("Content-Type"), "kind").alias("headers"),
        F.col("content").cast("binary").alias("body"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("failure_type"),
        F.timestamp_seconds(F.lit(FIRST_FETCH)).alias("fetched_at"),
    )


def chain_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_url, target_url``: each page to its first link, each link to the next."""
    pages = spread(table(spark, sf_dir, "pages"))
    nodes = F.concat(
        F.array("url"),
        F.transform(link_references(F.col("html"))["links"], lambda href: F.concat(url_origin(F.col("url")), href)),
    )
    linked = pages.select(nodes.alias("nodes")).where(F.size("nodes") > 1)
    steps = F.transform(
        F.sequence(F.lit(1), F.size("nodes") - 1),
        lambda i: F.struct(
            F.get("nodes", i - 1).alias("source_url"), F.get("nodes", i).alias("target_url")
        ),
    )
    return linked.select(F.explode(steps).alias("step")).select("step.*")
