"""Text blocks that many pages of a host repeat, and pages without them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.binding import literal, over
from pagemill.functions.html import HIDDEN, shown_chunks_sql
from pagemill.functions.urls import url_domain
from pagemill.operators.skew import lookup_join
from pagemill.session import cut_lineage
from pagemill.sources.tables import KeyedTable

# The tags that start or end a block.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table",
    "tbody", "td", "th", "thead", "title", "tr", "ul",
)
#: A block is boilerplate when it stands on more than ``MIN_PAGES`` pages of its host and on more
#: than ``PERCENT`` of a hundred of them, so that the rule reads alike for ten pages and ten million.
MIN_PAGES = 2
PERCENT = 10
#: A table of keys by host is broadcast up to this size; a key takes so many bytes.
BROADCAST_BYTES = 32 << 20
_KEY_BYTES = 48
_BLOCK_BREAK = r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + r")(?:[\s/][^>]*)?>"


def text_blocks(html: Column) -> Column:
    """The visible text of each block in document order, blanks left out."""
    shown = f"regexp_replace(page, {literal(HIDDEN)}, '')"
    blocks = f"""filter(transform(split({shown}, {literal(_BLOCK_BREAK)}),
        block -> array_join({shown_chunks_sql("block")}, ' ')), block -> block <> '')"""
    return over(html, "page", blocks)


def page_blocks(pages: DataFrame) -> DataFrame:
    """``seq, url, host, blocks`` of pages with ``content``."""
    return pages.select(
        "seq", "url", url_domain(F.col("url")).alias("host"), text_blocks(F.col("content")).alias("blocks")
    )


def _block_key(host: Column, block: Column) -> Column:
    return F.md5(F.concat_ws("\x00", host, block))


def block_counts(blocks: DataFrame) -> DataFrame:
    """``host, block, block_key, pages``: on how many pages of its host a block occurs.

    A page names a block once, so a plain count is the number of pages, and a block all
    pages share is combined before the shuffle.
    """
    named = blocks.select("host", F.explode(F.array_distinct("blocks")).alias("block"))
    return (
        named.groupBy("host", "block")
        .agg(F.count("*").alias("pages"))
        .withColumn("block_key", _block_key(F.col("host"), F.col("block")))
    )


def _on_many(counts: DataFrame, blocks: DataFrame, min_pages: int, percent: int) -> DataFrame:
    """The rows of ``counts`` (``host``, ``pages``, ...) above both limits; none without a host.

    A host may have a large share of all blocks, so its number of pages is joined with care.
    """
    hosts = blocks.groupBy("host").agg(F.count("*").alias("_host_pages"))
    often = counts.where(F.col("pages") > min_pages)
    sized = lookup_join(often, hosts, "host", hosts.withColumnRenamed("_host_pages", "rows"))
    return sized.where(F.col("pages") * 100 > F.col("_host_pages") * percent).drop("_host_pages")


def boilerplate_blocks(
    blocks: DataFrame, min_pages: int = MIN_PAGES, percent: int = PERCENT
) -> DataFrame:
    """``host, block, block_key, pages`` of blocks that many pages of their host repeat."""
    return _on_many(block_counts(blocks), blocks, min_pages, percent)


def keys_by_host(repeated: DataFrame) -> DataFrame:
    """``host, keys``: the keys of a host's boilerplate, at rest and marked for a broadcast if small.

    A host has at most 100 / ``PERCENT`` times as many as its pages have blocks.  All hosts
    together may have any number: beyond ``BROADCAST_BYTES`` the pages are joined by host.
    """
    table = cut_lineage(repeated.groupBy("host").agg(F.collect_set("block_key").alias("keys")))
    size = table.agg(F.sum(F.size("keys") * _KEY_BYTES + F.octet_length("host"))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def without_boilerplate(pages: DataFrame, by_host: DataFrame) -> DataFrame:
    """``pages`` (``host``, ``blocks``) with ``_kept``, the blocks that are no boilerplate."""
    known = by_host.select(F.col("host").alias("_host"), F.col("keys").alias("_keys"))
    joined = pages.join(known, F.col("host") == F.col("_host"), "left")
    kept = F.filter("blocks", lambda block: ~F.array_contains("_keys", _block_key(F.col("host"), block)))
    return joined.withColumn("_kept", F.when(F.col("_keys").isNull(), F.col("blocks")).otherwise(kept)).drop(
        "_host", "_keys"
    )


def joined_text(blocks: Column, kept: Column) -> Column:
    """A page's text; one with boilerplate alone keeps it."""
    return F.array_join(F.when(F.size(kept) == 0, blocks).otherwise(kept), "\n")


def key_counts(blocks: DataFrame) -> DataFrame:
    """``host, block_key, pages``: as :func:`block_counts` without the texts."""
    keys = F.transform("blocks", lambda block: _block_key(F.col("host"), block))
    once = blocks.select("host", F.explode(F.array_distinct(keys)).alias("block_key"))
    return once.groupBy("host", "block_key").agg(F.count("*").alias("pages"))


def clean_pages(
    blocks: DataFrame,
    boilerplate: DataFrame | None = None,
    min_pages: int = MIN_PAGES,
    percent: int = PERCENT,
) -> DataFrame:
    """``seq, url, text, dropped``: the blocks of each page that its host does not repeat.

    The pages are parsed once to count the keys of their blocks and once to leave blocks out, in
    the row.  Only keys are shuffled, each once per page.  A page with nothing else keeps its
    text.  A stored ``boilerplate`` table can stand in for the counts of these pages.
    """
    if boilerplate is None:
        boilerplate = _on_many(key_counts(blocks), blocks, min_pages, percent)
    cleaned = without_boilerplate(blocks, keys_by_host(boilerplate))
    dropped = F.when(F.size("_kept") == 0, F.lit(0)).otherwise(F.size("blocks") - F.size("_kept"))
    return cleaned.select(
        "seq", "url", joined_text(F.col("blocks"), F.col("_kept")).alias("text"), dropped.cast("long").alias("dropped")
    )


class HostBlocks:
    """How often the blocks of a host's pages occurred in all imports so far, at rest.

    ``blocks`` counts pages per block key, ``hosts`` pages per host; both grow batch by batch, and
    a replayed batch counts once, as it starts from the totals before it.  A page that is
    imported again counts again, on both sides of the share.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._blocks = KeyedTable(spark, f"{path}/blocks", "block_key")
        self._hosts = KeyedTable(spark, f"{path}/hosts", "host")

    def add(self, blocks: DataFrame, batch_id: int) -> DataFrame:
        """Count the pages (``host``, ``blocks``) of a batch; the boilerplate among their blocks.

        ``host, block_key, pages`` of blocks above both limits by the totals with this batch.
        """
        counted = cut_lineage(key_counts(blocks).where(F.col("host").isNotNull()))
        hosts = cut_lineage(blocks.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("pages")))
        totals = _added(self._blocks, counted.select("block_key", "host", "pages"), batch_id)
        host_totals = _added(self._hosts, hosts, batch_id).withColumnRenamed("pages", "_host_pages")
        repeated = totals.where(F.col("pages") > MIN_PAGES).join(host_totals, "host")
        return repeated.where(F.col("pages") * 100 > F.col("_host_pages") * PERCENT).drop("_host_pages")

    def fold(self, every: int | None) -> None:
        for table in (self._blocks, self._hosts):
            table.maybe_compact(every)


def _added(table: KeyedTable, counts: DataFrame, batch_id: int) -> DataFrame:
    """Add ``pages`` to the totals of the same keys, and store the new totals as the batch."""
    key = table.key
    old = table.slice(counts.select(key), batch_id)
    if old is not None:
        before = old.select(key, F.col("pages").alias("_before"))
        pages = F.col("pages") + F.coalesce("_before", F.lit(0))
        counts = counts.join(before, key, "left").withColumn("pages", pages).drop("_before")
    totals = cut_lineage(counts)
    table.append(totals, batch_id)
    return totals
