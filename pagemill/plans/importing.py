"""One import run as a logical plan, and its commit to tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.content import any_charset, is_html, is_textual
from pagemill.functions.urls import canonical_url, seed_url, sitemap_seeds, url_domain, url_matches
from pagemill.operators import frontier as fr
from pagemill.operators.boilerplate import (
    HostBlocks,
    joined_text,
    keys_by_host,
    text_blocks,
    without_boilerplate,
)
from pagemill.operators.filters import (
    accepted_pages,
    failure_details,
    has_failed,
    matching_pages,
    nth_value,
    response_predicate,
)
from pagemill.operators.keyed import keep_last
from pagemill.operators.links import new_links, page_links, scoped_links
from pagemill.operators.metrics import import_summary
from pagemill.operators.records import iso_utc, record_columns, with_stripped
from pagemill.operators.schema import conform, merge_schema
from pagemill.operators.search import TermIndex
from pagemill.operators.sitemaps import (
    parsed_sitemaps,
    robots_sitemaps,
    sitemap_children,
    sitemap_urls,
)
from pagemill.schemas import FRONTIER_SCHEMA, PAGE_SCHEMA, ImportOptions
from pagemill.session import cut_lineage, new_workspace, remove_folder
from pagemill.sources.responses import response_documents, with_content
from pagemill.sources.tables import KeyedTable


#: The root element of a sitemap or of an index of sitemaps.
SITEMAP_ROOT = r"(?i)<(?:[\w.-]+:)?(?:urlset|sitemapindex)[\s>]"


@dataclass(frozen=True)
class ImportResult:
    matched_records: int
    imported_records: int
    skipped_records: int
    pages_read: int
    discovered_urls: int = 0
    failed_urls: int = 0


@dataclass(frozen=True)
class ImportProgress:
    """What the progress callback receives after each stage: the counts of the run so far.

    ``pending_records`` are pages read and not yet stored, ``rows`` what the stage itself
    counted; the counters come from ``Observation`` of the writes, so none costs a scan.
    """

    stage: str
    result: ImportResult | None = None
    matched_records: int = 0
    imported_records: int = 0
    skipped_records: int = 0
    pages_read: int = 0
    pending_records: int = 0
    rows: int = 0


ProgressCallback = Callable[[ImportProgress], None]


def _judged(options: ImportOptions) -> tuple[Column, list[Column]]:
    """The outcome of a response document, and what went wrong with a failure."""
    outcome = (
        F.when(has_failed(), "failed")
        .when(~url_matches(F.col("url"), options.url_filter), None)
        .when(response_predicate(options.response_filter), "done")
        .otherwise("skipped")
    )
    return outcome, [value.alias(name) for name, value in failure_details().items()]


def _dropped_without_row(judged: DataFrame, extracted: DataFrame) -> DataFrame:
    """Outcomes where a page that gave no row counts as skipped."""
    kept = extracted.select("seq").distinct().withColumn("_kept", F.lit(True))
    dropped = (F.col("outcome") == "done") & F.col("_kept").isNull()
    return (
        judged.join(kept, "seq", "left")
        .withColumn("outcome", F.when(dropped, "skipped").otherwise(F.col("outcome")))
        .drop("_kept")
    )


def response_outcomes(
    documents: DataFrame, options: ImportOptions, extracted: DataFrame | None = None
) -> DataFrame:
    """One row per response: what became of it and, for failures, why.

    ``outcome`` is done, skipped, failed, or NULL for a page outside the URL filter.  It is
    decided within the row from narrow columns, unless the response filter asks for more;
    only a caller's extractor adds a join with the rows it gave.
    """
    outcome, details = _judged(options)
    judged = documents.select(
        "seq", "request_url", "url", "redirect_urls", "fetched_at", outcome.alias("outcome"), *details
    )
    return judged if extracted is None else _dropped_without_row(judged, extracted)


def _empty_frontier(spark: SparkSession) -> DataFrame:
    """No rows, in a form the optimizer recognizes, so that joins with it vanish."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in FRONTIER_SCHEMA.fields]
    return spark.range(1).where(F.lit(False)).select(*nothing)


@dataclass(frozen=True)
class StoredFrontier:
    """The URL states at rest, as of the batches before ``before``."""

    table: KeyedTable
    before: int | None = None

    def rows_of(self, urls: DataFrame) -> DataFrame | None:
        """The states of all spellings of these canonical URLs; only their buckets are read."""
        rows = self.table.slice(urls, self.before)
        return None if rows is None else rows.select(*FRONTIER_SCHEMA.names)


class ImportPlan:
    """The DataFrames of one run, each built when first asked for and computed when used.

    All of them derive from ``read``, one row per response with what the run needs of it, so
    after :meth:`settle` has stored that, no response is read again.
    """

    def __init__(
        self,
        responses: DataFrame,
        options: ImportOptions,
        frontier: DataFrame | StoredFrontier | None,
        seeds: DataFrame | None,
        at: Column | str | None,
        starts: DataFrame | None = None,
        follow: bool = True,
    ) -> None:
        documents, listed = response_documents(responses), None
        if options.include_sitemap and seeds is not None:
            documents, listed = _split_sitemaps(documents, seeds, options)
        if options.limit is not None:
            documents = _within_limit(documents, options)
        self.options, self.seeds, self._starts, self._follow = options, seeds, starts, follow
        self._documents, self._listed, self._at = documents, listed, at
        self._frontier, self._spark = frontier, responses.sparkSession
        self._folders: list[str] = []
        if options.extract is not None:
            self._extracting = self._extraction()

    def _at_rest(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read back."""
        folder = new_workspace(self._spark, name)
        self._folders.append(folder)
        df.write.option("compression", "zstd").parquet(folder)
        return self._spark.read.schema(df.schema).parquet(folder)

    def settle(self) -> dict[str, int]:
        """Read every response once and store what the run needs; the counts of what was read."""
        counted = Observation()
        kind = F.col("outcome")
        observed = self.read.observe(
            counted,
            F.count_if(kind.isin("done", "skipped")).alias("pages_read"),
            F.count_if(kind == "skipped").alias("filtered"),
            F.count_if(kind == "failed").alias("failed"),
        )
        self.read = self._at_rest(observed, "read")
        return counted.get

    def release(self) -> None:
        """Delete what :meth:`settle` and an extractor stored."""
        for folder in self._folders:
            remove_folder(self._spark, folder)
        self._folders.clear()

    @cached_property
    def read(self) -> DataFrame:
        """One row per response: its outcome, the page record and the links of its page.

        ``record`` is the default record of pages that are done, ``links`` the targets in scope
        of every page that was read, also of those the filters leave out.
        """
        return self._read(record=self.options.extract is None, links=self._follow)

    def _read(self, record: bool = False, links: bool = False) -> DataFrame:
        options = self.options
        outcome, details = _judged(options)
        linking = ~has_failed() & is_textual(F.col("content_type"))
        # Every column of a response may be asked for by the response filter, so it is judged first.
        pages = self._documents.withColumn("outcome", outcome).withColumn("_linking", linking)
        columns = ["seq", "request_url", "url", "redirect_urls", "fetched_at", "outcome", *details]
        done = F.col("outcome") == "done"
        if record or links:
            pages = with_content(pages, F.col("_linking") | done)
        if record:
            pages = with_stripped(pages, options)
            columns.append(F.when(done, F.struct(*record_columns(options))).alias("record"))
            if options.drop_boilerplate:
                counted = done & is_html(F.col("content_type"))
                columns.append(F.when(counted, text_blocks(F.col("_stripped"))).alias("blocks"))
        if links:
            found = page_links(F.col("url"), F.col("content"))
            scoped = scoped_links(found, F.col("url"), options.url_filter, options.domain)
            columns.append(F.when(F.col("_linking"), scoped).alias("links"))
        return pages.select(*columns)

    def _part(self, **parts: bool) -> DataFrame:
        """What was read if it is at rest, else a pass over the responses for these parts alone."""
        return self.read if "read" in self.__dict__ else self._read(**parts)

    def _extraction(self) -> DataFrame:
        """The rows of the caller's extractor, still to be computed."""
        accepted = matching_pages(self._documents, self.options.url_filter)
        accepted = accepted_pages(accepted, self.options.response_filter)
        with any_charset(self._spark):
            rows = self.options.extract(accepted)
        for name in (self.options.primary_key, "seq"):
            if name not in rows.columns:
                what = "return primary key column" if name != "seq" else "keep column"
                raise ValueError(f"extract must {what} {name!r}")
        return rows

    @cached_property
    def _extracted(self) -> DataFrame:
        """Rows to choose from, with ``seq``; without a key a row cannot be stored.

        An extractor runs once: its rows are stored with a number each.
        """
        if self.options.extract is None:
            done = self._part(record=True).where(F.col("outcome") == "done")
            rows = done.select("seq", "url", "record.*", *(["blocks"] if self.options.drop_boilerplate else []))
        else:
            # Parquet has no column without a type.
            typed = [
                F.col(f.name).cast("string") if f.dataType.typeName() == "void" else F.col(f.name)
                for f in self._extracting.schema
            ]
            rows = self._extracting.select(*typed, F.monotonically_increasing_id().alias("_row"))
            rows = self._at_rest(rows, "extracted")
        return rows.where(F.col(self.options.primary_key).isNotNull())

    @cached_property
    def records(self) -> DataFrame:
        """The rows to store, one per key, with the ``seq`` they come from.

        The last response of a key counts, and of several rows from it one that the rows alone
        decide.  Winners are found from narrow columns.
        """
        rows, key = self._extracted, self.options.primary_key
        if self.options.extract is None:
            return keep_last(rows, key) if key != "seq" else rows
        content = F.xxhash64(F.to_json(F.struct(*(c for c in rows.columns if c != "_row"))))
        order = F.struct(F.col("seq"), content, F.col("_row"))
        winners = rows.groupBy(key).agg(F.max_by("_row", order).alias("_row")).select("_row")
        return rows.join(winners, "_row", "left_semi").drop("_row")

    @cached_property
    def imported(self) -> DataFrame:
        """One row per stored key."""
        if self.options.extract is None and self.options.primary_key == "url":
            return self._part().where("outcome = 'done' AND url IS NOT NULL").select("url").distinct()
        return self._extracted.select(self.options.primary_key).distinct()

    @cached_property
    def outcomes(self) -> DataFrame:
        """One row per response with its ``outcome``; without a row from its page it is skipped."""
        judged = self._part().drop("record", "links", "blocks")
        if self.options.extract is None and self.options.primary_key in ("url", "seq"):
            return judged
        return _dropped_without_row(judged, self._extracted)

    @cached_property
    def _edges(self) -> DataFrame:
        """``seq, source_url, target_url`` of the links in scope, those of sitemaps too."""
        if not self._follow:
            return self._spark.createDataFrame([], "seq long, source_url string, target_url string")
        # Of a plain column the optimizer would ask whether it is empty, and build the links twice.
        links = F.coalesce("links", F.array().cast("array<string>"))
        pages = self._part(links=True)
        edges = pages.select("seq", F.col("url").alias("source_url"), F.explode(links).alias("target_url"))
        if self._listed is not None:
            edges = edges.unionByName(self._listed.select(*edges.columns))
        return edges

    @cached_property
    def _stored(self) -> bool:
        """Whether there are URL states at all."""
        if isinstance(self._frontier, StoredFrontier):
            return self._frontier.table.schema(self._frontier.before) is not None
        return self._frontier is not None

    @cached_property
    def _known(self) -> DataFrame:
        """The stored states this run may touch: one read of the buckets of its URLs."""
        if not self._stored:
            return _empty_frontier(self._spark)
        if not isinstance(self._frontier, StoredFrontier):
            return self._frontier
        touched = fr.page_identities(self.outcomes).select("url")
        touched = touched.unionByName(self._edges.select(F.col("target_url").alias("url")))
        for urls in (self.seeds, self._starts):
            if urls is not None:
                touched = touched.unionByName(urls.select("url"))
        return cut_lineage(self._frontier.rows_of(cut_lineage(touched.distinct())))

    @cached_property
    def discovered(self) -> DataFrame:
        """Links to URLs that neither the frontier nor the seeds know."""
        known = fr.frontier_state(self._known).select("url")
        if self.seeds is not None:
            known = known.unionByName(self.seeds.select("url"))
        if self._starts is not None:
            known = known.unionByName(self._starts.select("url"))
        return new_links(self._edges, known)

    @cached_property
    def unresolved(self) -> DataFrame | None:
        """Seeds without a response; after a limited run they are still to fetch."""
        if self.seeds is None or self.options.limit is not None:
            return None
        answered = fr.page_identities(self.outcomes).select("url").distinct()
        return fr.unresolved_seeds(self.seeds, fr.expand_aliases(answered, self._known))

    @cached_property
    def frontier_updates(self) -> DataFrame:
        """One row per URL whose state this run changes."""
        at = self._at
        if at is None:
            at = self._part().agg(iso_utc(F.max("fetched_at"))).scalar()
        events = fr.outcome_events(self.outcomes.where(F.col("outcome").isNotNull()))
        settled = fr.expand_aliases(events, self._known)
        pending = fr.discovered_rows(self.discovered, at)
        updates = fr.frontier_rows(settled, at).unionByName(
            pending.join(events.select("url"), "url", "left_anti")
        )
        if self.unresolved is not None:
            updates = updates.unionByName(
                fr.frontier_rows(self.unresolved, at), allowMissingColumns=True
            )
        if self._starts is not None:
            # A start URL that this run neither read nor gave up is still to fetch.
            waiting = fr.insert_seeds(self._known, self._starts, at)
            settled_urls = events.select("url")
            if self.unresolved is not None:
                settled_urls = settled_urls.unionByName(self.unresolved.select("url"))
            updates = updates.unionByName(
                waiting.join(settled_urls, "url", "left_anti"), allowMissingColumns=True
            )
        updates = updates.select(*FRONTIER_SCHEMA.names)
        if not self._stored:
            return updates
        if not self.options.replace_whole_row:
            updates = fr.carry_discovery(self._known, updates)
        # Spellings that lag behind the state their canonical URL had before.
        raised = fr.reconcile_aliases(self._known).withColumnRenamed("status", "_status")
        lagging = self._known.join(raised, "url").join(updates.select("url"), "url", "left_anti")
        # Only the spelling's discovery is kept; what went wrong with it before is settled.
        settled_rows = lagging.select("url", "source_url", F.col("_status").alias("status"))
        found = fr.carry_discovery(self._known, fr.frontier_rows(settled_rows, at))
        return updates.unionByName(found.select(*FRONTIER_SCHEMA.names))

    def summary(self) -> DataFrame:
        return import_summary(self.outcomes, self.imported, self.discovered, self.unresolved)


def plan_import(
    responses: DataFrame,
    options: ImportOptions | None = None,
    frontier: DataFrame | StoredFrontier | None = None,
    seeds: DataFrame | None = None,
    at: Column | str | None = None,
    starts: DataFrame | None = None,
    follow: bool = True,
) -> ImportPlan:
    """Turn responses into page rows, outcomes, new links and frontier updates.

    ``frontier`` is the URL state, ``seeds`` (canonical ``url``) are the URLs this run set out to
    fetch, and ``at`` stamps the frontier rows (the newest fetch time of the run by default).
    ``starts`` (canonical ``url``) enter the frontier as pending if the run settles nothing about
    them.  Without ``follow`` no links are taken.
    """
    return ImportPlan(responses, options or ImportOptions(), frontier, seeds, at, starts, follow)


def _within_limit(documents: DataFrame, options: ImportOptions) -> DataFrame:
    """The responses up to the page that reaches the limit; later ones were never fetched."""
    if options.limit == 0:
        return documents.where(F.lit(False))
    wanted = matching_pages(documents, options.url_filter)
    reached = nth_value(wanted.select(F.col("seq").alias("value")), options.limit)
    return documents if reached is None else documents.where(F.col("seq") <= reached)


def _split_sitemaps(
    documents: DataFrame, seeds: DataFrame, options: ImportOptions
) -> tuple[DataFrame, DataFrame]:
    """The responses that are not robots files or sitemaps, and the links those list.

    Robots files name sitemaps and sitemaps name others: hop by hop only the responses with the
    URLs of the hop are decoded, whatever their content type says.
    """
    named = cut_lineage(
        documents.where(F.coalesce(F.col("status") < 400, F.lit(False))).select(
            "seq", canonical_url(F.col("url")).alias("_canonical")
        )
    )

    def fetched(urls: DataFrame) -> DataFrame:
        hop = named.join(urls.select(F.col("url").alias("_canonical")), "_canonical", "left_semi")
        found = documents.join(hop, "seq").withColumn("url", F.col("_canonical"))
        return with_content(found)

    starts = cut_lineage(sitemap_seeds(seeds).select(F.col("sitemap_url").alias("url")).distinct())
    robots = F.col("url").endswith("/robots.txt")
    listed = robots_sitemaps(fetched(starts.where(robots)), options.domain)
    reached = starts.where(robots)
    hop = cut_lineage(
        starts.where(~robots).unionByName(listed.select(F.col("sitemap_url").alias("url"))).distinct()
    )
    links = None
    while not hop.isEmpty():
        reached = reached.unionByName(hop)
        # Servers send sitemaps under any content type, so the content says which ones they are.
        sitemaps = fetched(hop).where(F.col("content").rlike(SITEMAP_ROOT))
        parsed = cut_lineage(parsed_sitemaps(sitemaps))
        found = sitemap_urls(parsed, options.url_filter, options.domain)
        links = found if links is None else links.unionByName(found)
        children = sitemap_children(parsed, options.domain).select(F.col("sitemap_url").alias("url"))
        hop = cut_lineage(children.distinct().join(reached, "url", "left_anti"))
    sitemap_pages = canonical_url(F.col("url")).alias("_canonical")
    others = documents.withColumn("_canonical", sitemap_pages).join(
        reached.select(F.col("url").alias("_canonical")), "_canonical", "left_anti"
    )
    if links is None:
        links = sitemap_urls(parsed_sitemaps(fetched(hop)), options.url_filter, options.domain)
    return others.drop("_canonical"), links


def canonical_seeds(urls: DataFrame) -> DataFrame:
    """Canonical start URLs from a ``url`` column of URLs or bare domains; bad ones fail."""
    return urls.select(canonical_url(seed_url(F.col("url"), "raise")).alias("url")).distinct()


def work_seeds(
    frontier: DataFrame | None, starts: DataFrame | None, options: ImportOptions
) -> DataFrame | None:
    """What a run sets out to fetch: the stored worklist, or the start URLs when new."""
    if frontier is None:
        return starts
    if starts is not None:
        frontier = frontier.unionByName(fr.insert_seeds(frontier, starts, ""))
    return fr.resume_worklist(frontier, options.retry_failed, options.url_filter, options.limit)


@dataclass
class Counters:
    """The counts of a run so far, reported with each stage."""

    report: ProgressCallback
    matched: int = 0
    imported: int = 0
    skipped: int = 0
    pending: int = 0
    discovered: int = 0
    failed: int = 0

    def stage(self, name: str, rows: int = 0, result: ImportResult | None = None) -> None:
        self.report(
            ImportProgress(
                name, result, self.matched, self.imported, self.skipped, self.matched, self.pending, rows
            )
        )

    def result(self) -> ImportResult:
        return ImportResult(
            self.matched, self.imported, self.skipped, self.matched, self.discovered, self.failed
        )


def commit(
    plan: ImportPlan,
    pages: KeyedTable,
    frontier: KeyedTable | None,
    batch_id: int,
    options: ImportOptions,
    counters: Counters | None = None,
    index: TermIndex | None = None,
    blocks: HostBlocks | None = None,
) -> bool:
    """Read the responses once, write page rows, then the URL states that depend on them.

    When storage refuses the page rows for good, their URLs are marked failed instead and
    the run goes on.  Returns whether the pages were written.
    """
    counters = counters or Counters(lambda _: None)
    try:
        return _commit(plan, pages, frontier, batch_id, options, counters, index, blocks)
    finally:
        plan.release()


def _commit(plan, pages, frontier, batch_id, options, counters, index, blocks) -> bool:
    _check_index(plan, options)
    counts = plan.settle()
    counters.matched, counters.failed = counts["pages_read"], counts["failed"]
    counters.skipped = counts["filtered"]
    for stage, rows in (("page_scraped", counters.matched), ("request_failed", counters.failed),
                        ("response_filtered", counters.skipped)):
        if rows:
            counters.stage(stage, rows)
    if options.extract is not None:
        # Narrow rows at rest; nothing is read or extracted again.
        left = plan.outcomes.where(F.col("outcome") == "skipped").count()
        if left > counters.skipped:
            dropped, counters.skipped = left - counters.skipped, left
            counters.stage("record_skipped", dropped)
    counters.pending = counters.matched - counters.skipped
    if counters.pending:
        counters.stage("record_extracted", counters.pending)
    records = plan.records
    if blocks is not None:
        records = _without_boilerplate(records, blocks, batch_id)
    records = _conformed(records, options)
    stored = _write_pages(pages, records, batch_id, options.write_waits)
    written = stored is not None
    if written and index is not None:
        index.append(records, batch_id)
    lost, counters.pending = 0 if written else counters.pending, 0
    counters.imported, counters.skipped = stored or 0, counters.skipped + lost
    counters.stage("batch_merged" if written else "batch_write_failed", stored or lost)
    if frontier is None:
        if plan.unresolved is not None:
            counters.failed += plan.unresolved.count()
        return written
    updates = plan.frontier_updates
    if not written:
        done = F.col("status") == "done"
        lost = fr.write_failed_rows(updates.where(done).withColumn("seq", F.lit(0)))
        lost = fr.frontier_rows(lost.drop("seq"), updates.agg(F.max("updated_at")).scalar())
        updates = updates.where(~done).unionByName(lost)
    settled = Observation()
    # New links have a source; a waiting start URL has none.
    discovered = (F.col("status") == "pending") & F.col("source_url").isNotNull()
    unanswered = (F.col("status") == "failed") & (F.col("failure_type") == fr.UNANSWERED_TYPE)
    frontier.append(
        updates, batch_id, settled,
        {"discovered": F.count_if(discovered), "unanswered": F.count_if(unanswered)},
    )
    counters.discovered = settled.get["discovered"]
    counters.failed += settled.get["unanswered"]
    if counters.discovered:
        counters.stage("frontier_discovered", counters.discovered)
    return written


def _without_boilerplate(records: DataFrame, blocks: HostBlocks, batch_id: int) -> DataFrame:
    """Page rows whose text has lost the blocks that their host repeats."""
    pages = records.withColumn("host", url_domain(F.col("url")))
    counted = pages.where(F.col("blocks").isNotNull()).select("host", "blocks")
    cleaned = without_boilerplate(pages, keys_by_host(blocks.add(counted, batch_id)))
    text = F.when(F.col("blocks").isNull(), F.col("text")).otherwise(
        joined_text(F.col("blocks"), F.col("_kept"))
    )
    return cleaned.withColumn("text", text).drop("host", "blocks", "_kept")


def _conformed(records: DataFrame, options: ImportOptions) -> DataFrame:
    if options.primary_key != "seq":
        records = records.drop("seq")
    if options.schema is not None:
        # An explicit schema adds columns; what the extractor gives besides is kept.
        return conform(records, merge_schema(options.schema, records.schema, options.primary_key))
    return conform(records, PAGE_SCHEMA) if options.extract is None else records


def _check_index(plan: ImportPlan, options: ImportOptions) -> None:
    """An index column the page rows lack is an error before anything is read or written."""
    if not options.indexed:
        return
    columns = set(PAGE_SCHEMA.names) if options.extract is None else set(plan._extracting.columns)
    columns |= set(options.schema.names) if options.schema is not None else set()
    for name in options.indexed:
        if name not in columns:
            raise ValueError(f"index_columns names {name!r}, which the page rows do not have")


def _write_pages(
    pages: KeyedTable, records: DataFrame, batch_id: int, waits: Sequence[float]
) -> int | None:
    """Append, again after each of ``waits`` while storage refuses; the rows, None if it failed.

    Any other failure (a source that cannot be read, a lost shuffle) is raised, so that the
    run or the micro-batch is repeated and no page is given up for it.
    """
    for wait in (*waits, None):
        stored = Observation()
        try:
            pages.append(records, batch_id, stored, {"rows": F.count("*")})
            return stored.get["rows"]
        except Exception as error:
            if not _refused(error, f"{pages.path}/log"):
                raise
        if wait is not None:
            time.sleep(wait)
    return None


def _refused(error: Exception, folder: str) -> bool:
    """Whether ``error`` stems from an ``IOException`` about a path in ``folder``."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    gateway = None if cause is None else SparkSession.active().sparkContext._gateway
    while cause is not None:
        if is_instance_of(gateway, cause, "java.io.IOException") and folder in str(cause.getMessage()):
            return True
        cause = cause.getCause()
    return False


def run_import(
    spark: SparkSession,
    responses: DataFrame,
    table: str,
    url: str | None = None,
    options: ImportOptions | None = None,
    resume: bool = False,
    frontier_table: str | None = None,
    progress: ProgressCallback | None = None,
    **settings,
) -> ImportResult:
    """Import captured responses into the table folder ``table``; the batch entry point.

    ``url`` is the start URL or domain.  With ``resume`` the URL states are kept beside the
    table (in ``<table>__frontier``) and decide what the run was to fetch.  Further keyword
    arguments are :class:`ImportOptions` fields.
    """
    options = options or ImportOptions(**settings)
    counters = Counters(progress or (lambda _: None))
    table = table.rstrip("/")
    pages = page_table_at(spark, table, options)
    states = known = seeds = None
    starts = None if url is None else canonical_seeds(spark.createDataFrame([(url,)], ["url"]))
    if resume:
        counters.stage("loading_frontier")
        states = frontier_table_at(spark, frontier_table or f"{table}__frontier", options)
        # The worklist folds all spellings of a URL to the highest state of any.
        known = states.current()
        seeds = work_seeds(known, starts, options)
        seeds = None if seeds is None else cut_lineage(seeds)
        counters.stage("frontier_loaded", 0 if seeds is None else seeds.count())
    counters.stage("started")
    plan = plan_import(
        responses, options, StoredFrontier(states) if resume else None, seeds if resume else starts,
        starts=starts if resume else None, follow=resume,
    )
    batch_id = max(pages.next_batch(), states.next_batch() if states else 0)
    index = TermIndex(spark, f"{table}__terms", options.primary_key) if options.indexed else None
    blocks = HostBlocks(spark, f"{table}__blocks") if options.drop_boilerplate else None
    written = commit(plan, pages, states, batch_id, options, counters, index, blocks)
    if blocks is not None:
        blocks.fold(options.optimize_every)
    for stored in filter(None, (pages if written else None, states)):
        if stored.maybe_compact(options.optimize_every, lambda: counters.stage("optimizing")):
            counters.stage("optimized")
    result = counters.result()
    counters.stage("completed", result=result)
    return result


def page_table_at(spark: SparkSession, path: str, options: ImportOptions) -> KeyedTable:
    return KeyedTable(spark, path, options.primary_key, None, options.buckets, options.batch_size)


def frontier_table_at(spark: SparkSession, path: str, options: ImportOptions) -> KeyedTable:
    return KeyedTable(spark, path, "url", "status", options.buckets, options.frontier_batch_size)
