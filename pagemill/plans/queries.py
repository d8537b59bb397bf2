"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import content as ct
from pagemill.functions import html, urls
from pagemill.operators import batches, boilerplate, filters, keyed, links, metrics, records, schema
from pagemill.operators import frontier as fr
from pagemill.operators import search, sitemaps
from pagemill.plans import corpus
from pagemill.plans.importing import plan_import, response_outcomes, run_import
from pagemill.schemas import ImportOptions
from pagemill.session import new_workspace
from pagemill.sources.responses import lower_header_names, spread, stream_responses, with_content
from pagemill.sources.tables import KeyedTable
from pagemill.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Arguments the queries share with their SQL.
URL_PATTERNS = (r"/en/\d+5", r"\.html$")
SCOPE = "https://m.ththth.example.net/en"
PAGE_LIMIT = 120
SEARCH_TERMS = ("the", "que", "und")
BATCH_ROWS, BATCH_OCTETS = 4, 12_000
ALL_STEPS = "scripts,css,whitespace,image-data-urls"


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- sources, tables, keyed rows -------------------------------------------------------


@query
def responses_scan(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select(
        "seq", "url", "request_url", "status", "content_type",
        records.iso_utc(F.col("fetched_at")).alias("fetched_at"),
        F.octet_length("body").cast("long").alias("octets"),
    )


def _stored_frontier(spark, sf_dir) -> KeyedTable:
    stored = KeyedTable(spark, new_workspace(spark, "frontier"), "url", "status")
    stored.append(corpus.frontier(spark, sf_dir))
    stored.compact()
    return stored


@query
def frontier_scan(spark, sf_dir):
    return _stored_frontier(spark, sf_dir).current().select("url", "status")


@query
def frontier_by_status(spark, sf_dir):
    pending = _stored_frontier(spark, sf_dir).current().where(F.col("status") == "pending")
    return pending.select("url", "source_url", "discovered_at")


def _page_versions(spark, sf_dir):
    """The stored pages and a batch of updates that replaces some and adds others."""
    pages = corpus.table(spark, sf_dir, "pages")
    address = F.regexp_replace("url", "[?#].*$", "")
    body = F.md5("html").alias("digest")
    stored = pages.select(address.alias("url"), body, F.col("page_id").alias("seq"))
    moved = F.when(F.col("page_id") % 3 == 0, F.concat(address, F.lit("/new"))).otherwise(address)
    updates = pages.select(
        moved.alias("url"),
        F.md5(F.reverse("html")).alias("digest"),
        F.col("page_id").alias("seq"),
        F.lit(2).cast("long").alias("revision"),
    )
    return stored, updates


@query
def upsert_pages(spark, sf_dir):
    stored, updates = _page_versions(spark, sf_dir)
    return keyed.upsert(keyed.keep_last(stored, "url"), updates, "url", "seq")


@query
def compact_pages(spark, sf_dir):
    stored, updates = _page_versions(spark, sf_dir)
    table = KeyedTable(spark, new_workspace(spark, "pages"), "url")
    table.append(keyed.keep_last(stored, "url"))
    table.append(keyed.keep_last(updates, "url"))
    table.compact()
    again = updates.withColumn("revision", F.lit(3).cast("long"))
    table.append(keyed.keep_last(again.withColumn("url", F.concat("url", F.lit("/new"))), "url"))
    table.compact()
    return table.current()


@query
def dedupe_last(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select(
        urls.url_domain(F.col("url")).alias("host"), F.col("page_id").alias("seq"), "url", "html"
    )
    last = keyed.keep_last(pages, "host")
    return last.select("host", "seq", "url", F.md5("html").alias("digest"))


@query
def unique_first(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"), F.explode(html.link_references(F.col("html"))["links"]).alias("href")
    )
    return keyed.unique_first(pages, "href")


@query
def schema_evolve(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    stored = pages.select("url", F.length("html").cast("long").alias("n_chars"))
    incoming = pages.select(
        F.concat("url", F.lit("/v2")).alias("url"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.lit(None).alias("note"),
    )
    old, new, _ = schema.evolve(stored, incoming, "url")
    return old.unionByName(new)


@query
def text_postings(spark, sf_dir):
    return search.text_postings(spread(corpus.table(spark, sf_dir, "documents")), "doc_id")


@query
def term_search(spark, sf_dir):
    """Search in a stored index whose second batch replaces a third of the first."""
    docs = spread(corpus.table(spark, sf_dir, "documents"))
    index = search.TermIndex(spark, new_workspace(spark, "terms"), "doc_id")
    old = F.when(F.col("doc_id") % 3 == 0, F.lit("the old text und que")).otherwise(F.col("text"))
    index.append(docs.select("doc_id", old.alias("text")), 0)
    index.append(docs.where("doc_id % 3 = 0"), 1)
    return index.search(SEARCH_TERMS)


def _text_records(spark, sf_dir):
    options = ImportOptions(content_format="text", strip="scripts,image-data-urls")
    return records.page_records(filters.accepted_pages(corpus.contents(spark, sf_dir)), options)


@query
def record_bytes(spark, sf_dir):
    rows = _text_records(spark, sf_dir)
    columns = ["url", "date", "content_type", "text", "images"]
    return rows.select("seq", records.record_bytes(rows, columns).alias("record_bytes"))


def _sized_pages(spark, sf_dir):
    return corpus.table(spark, sf_dir, "pages").select(
        urls.url_domain(F.col("url")).alias("host"),
        F.col("page_id").alias("seq"),
        F.octet_length("html").cast("long").alias("record_bytes"),
    )


@query
def write_batches(spark, sf_dir):
    """The batch in which one writer a host would write each page, as read from files of few rows."""
    numbered = batches.number_batches(
        _sized_pages(spark, sf_dir), "host", "seq", "record_bytes", BATCH_ROWS, BATCH_OCTETS
    )
    path = new_workspace(spark, "batches")
    batches.write_batches(numbered, path, "host", BATCH_ROWS)
    stored = spark.read.schema(numbered.schema).parquet(path)
    return stored.select("host", "seq", "record_bytes", "batch")


@query
def batch_files(spark, sf_dir):
    """Pages written in files of few rows, and how long the files became."""
    path = new_workspace(spark, "batches")
    pages = _sized_pages(spark, sf_dir)
    batches.write_batches(pages, path, "host", BATCH_ROWS)
    return batches.batch_files(spark.read.schema(pages.schema).parquet(path), "host", "record_bytes")


# --- URLs --------------------------------------------------------------------------------


@query
def seed_urls(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    bare = F.regexp_replace("url", "^https?://", "")
    kind = F.col("page_id") % 6
    value = (
        F.when(kind == 0, bare)
        .when(kind == 1, F.regexp_extract(bare, "^[^/]*", 0))
        .when(kind == 2, F.concat(F.lit("ftp://"), bare))
        .when(kind == 3, F.concat(F.lit("/"), bare))
        .otherwise(F.col("url"))
    )
    given = pages.select("page_id", value.alias("value"))
    return given.select("page_id", "value", urls.seed_url(F.col("value")).alias("seed"))


@query
def url_domain(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    spelled = F.when(
        F.col("page_id") % 2 == 0, F.regexp_replace("url", "://([^/]*)", "://User:pw@$1.:8443")
    ).otherwise(F.upper("url"))
    return pages.select("page_id", urls.url_domain(spelled).alias("domain"))


@query
def url_canonical(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    kind = F.col("page_id") % 5
    spelled = (
        F.when(kind == 0, F.concat(F.lit(" "), F.upper("url"), F.lit("#Frag")))
        .when(kind == 1, F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit(";?#x")))
        .when(kind == 2, F.regexp_extract("url", "^https?://[^/]*", 0))
        .when(kind == 3, F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit(";a=B?Q=1&p;")))
        .otherwise(F.col("url"))
    )
    return pages.select("page_id", urls.canonical_url(spelled).alias("canonical"))


@query
def url_filter(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(urls.url_matches(F.col("url"), URL_PATTERNS))


@query
def url_prefix_scope(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(urls.url_matches(F.col("url"), urls.prefix_scope_pattern(SCOPE)))


@query
def sitemap_seeds(spark, sf_dir):
    return urls.sitemap_seeds(corpus.table(spark, sf_dir, "pages"))


# --- filters, routing, limits ------------------------------------------------------------


@query
def text_responses(spark, sf_dir):
    return filters.accepted_pages(corpus.documents(spark, sf_dir)).select("seq", "url", "content_type")


@query
def response_filter(spark, sf_dir):
    rule = "headers['content-type'] LIKE '%html%' OR url LIKE '%.html'"
    return filters.accepted_pages(corpus.documents(spark, sf_dir), rule).select("seq", "url")


@query
def headers_lower(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    number = F.col("page_id").cast("string")
    headers = F.map_from_arrays(
        F.array(F.lit("X-Page"), F.lit("Content-Type"), F.lit("x-page")),
        F.array(F.lit("old"), F.lit("text/html"), number),
    )
    lowered = pages.select("page_id", lower_header_names(headers).alias("h"))
    return lowered.select(
        "page_id", F.explode("h").alias("name", "value")
    )


@query
def failed_responses(spark, sf_dir):
    return filters.failed_responses(corpus.documents(spark, sf_dir))


@query
def limit_pages(spark, sf_dir):
    pages = filters.matching_pages(corpus.documents(spark, sf_dir), None)
    return filters.limit_pages(pages, PAGE_LIMIT).select("seq", "url")


# --- content -----------------------------------------------------------------------------


@query
def content_kind(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    kinds = ("text/html; charset=UTF-8", 'text/html;Charset="latin-1"', "application/xhtml+xml",
             "image/png; q=1; charset = utf-16 ; x=y", "application/json", "")
    kind = corpus.by_remainder(F.col("page_id"), kinds)
    named = pages.select("page_id", kind.alias("content_type"))
    return named.select(
        "page_id",
        "content_type",
        ct.charset(F.col("content_type")).alias("charset"),
        ct.is_html(F.col("content_type")).alias("is_html"),
        ct.is_textual(F.col("content_type")).alias("is_textual"),
    )


@query
def decode_body(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    kind = F.col("page_id") % 4
    latin = F.regexp_replace("html", r"[^\x00-\x{FF}]", "?")
    body = (
        F.when(kind == 0, F.concat(F.unhex(F.lit("FF")), F.col("html").cast("binary")))
        .when(kind == 1, F.encode(latin, "ISO-8859-1"))
        .when(kind == 2, F.encode("html", "UTF-16LE"))
        .otherwise(F.col("html").cast("binary"))
    )
    label = corpus.by_remainder(
        F.col("page_id"),
        ("text/html", "text/html; charset=ISO-8859-1", "text/html; charset=utf-16-le",
         "text/html; charset=no-such-charset"),
    )
    captured = pages.select("page_id", body.alias("body"), label.alias("content_type"))
    return with_content(captured).select("page_id", F.col("content").alias("text"))


def _stripped(spark, sf_dir, step):
    return corpus.contents(spark, sf_dir).select("seq", step(F.col("content")).alias("text"))


@query
def strip_scripts(spark, sf_dir):
    return _stripped(spark, sf_dir, ct.strip_scripts)


@query
def strip_css(spark, sf_dir):
    return _stripped(spark, sf_dir, ct.strip_css)


@query
def strip_image_data(spark, sf_dir):
    return _stripped(spark, sf_dir, ct.strip_image_data)


@query
def strip_whitespace(spark, sf_dir):
    return _stripped(spark, sf_dir, ct.strip_whitespace)


@query
def strip_html(spark, sf_dir):
    kinds = ImportOptions(strip=ALL_STEPS).kinds
    stripped = ct.strip_html(F.col("content"), F.col("content_type"), kinds)
    return corpus.contents(spark, sf_dir).select("seq", stripped.alias("text"))


@query
def images_raw_vs_stripped(spark, sf_dir):
    """Both orders side by side in one pass over the pages."""
    orders = ("before-links", "after-links")
    pages = records.with_stripped(corpus.contents(spark, sf_dir), ImportOptions(clean=orders[0]))
    found = {
        order.replace("-", "_"): records.images_in_order(ImportOptions(clean=order)) for order in orders
    }
    return pages.select("seq", *(F.array_join(images["src"], " ").alias(name) for name, images in found.items()))


@query
def html_text(spark, sf_dir):
    return _stripped(spark, sf_dir, html.html_text)


@query
def html_markdown(spark, sf_dir):
    return _stripped(spark, sf_dir, html.html_markdown)


@query
def page_images(spark, sf_dir):
    images = records.page_images(F.col("content"), F.col("content_type"))
    found = corpus.contents(spark, sf_dir).select("seq", F.posexplode(images).alias("position", "image"))
    return found.select("seq", F.col("position").cast("long").alias("position"), "image.src", "image.alt")


def _record_view(rows):
    return rows.select(
        "seq", "url", "date", "content_type", "text",
        F.array_join("images.src", " ").alias("image_sources"),
        F.array_join("images.alt", " ").alias("image_texts"),
    )


@query
def page_records(spark, sf_dir):
    pages = filters.accepted_pages(filters.matching_pages(corpus.contents(spark, sf_dir), None))
    return _record_view(records.page_records(pages))


@query
def page_records_html(spark, sf_dir):
    pages = filters.accepted_pages(filters.matching_pages(corpus.contents(spark, sf_dir), None))
    return _record_view(records.page_records(pages, ImportOptions(content_format="html")))


@query
def boilerplate_blocks(spark, sf_dir):
    blocks = boilerplate.page_blocks(corpus.contents(spark, sf_dir))
    return boilerplate.boilerplate_blocks(blocks).select("host", "block", "pages")


@query
def clean_pages(spark, sf_dir):
    return boilerplate.clean_pages(boilerplate.page_blocks(corpus.contents(spark, sf_dir)))


@query
def custom_extract(spark, sf_dir):
    """A caller's extractor with its own key; pages without a row count as skipped."""

    def titles(documents: DataFrame) -> DataFrame:
        title = F.regexp_extract(F.col("body").cast("string"), "(?s)<title>(.*?)</title>", 1)
        named = documents.select("seq", F.split(title, " ")[0].alias("word"), title.alias("title"))
        return named.where(F.length("word") > 3)

    options = ImportOptions(extract=titles, primary_key="word")
    return plan_import(corpus.responses(spark, sf_dir), options).records


# --- links, sitemaps ---------------------------------------------------------------------


def _edges(spark, sf_dir):
    pages = filters.accepted_pages(corpus.contents(spark, sf_dir))
    return links.link_edges(pages.where(~filters.has_failed()))


@query
def link_edges(spark, sf_dir):
    return _edges(spark, sf_dir).drop("link_domain")


@query
def links_in_scope(spark, sf_dir):
    return links.links_in_scope(_edges(spark, sf_dir), [r"/[a-m]"]).select("seq", "source_url", "target_url")


def _known(spark, sf_dir):
    """Every second link of a page (by length of its URL) is known already."""
    known = _edges(spark, sf_dir).where(F.length("target_url") % 2 == 0)
    return known.select(F.col("target_url").alias("url")).distinct()


@query
def links_new(spark, sf_dir):
    return links.new_links(links.links_in_scope(_edges(spark, sf_dir)), _known(spark, sf_dir))


@query
def frontier_discovered(spark, sf_dir):
    fresh = links.new_links(links.links_in_scope(_edges(spark, sf_dir)), _known(spark, sf_dir))
    return fr.discovered_rows(fresh, corpus.SEED_STAMP).drop("seq")


@query
def crawl_depth(spark, sf_dir):
    seeds = corpus.table(spark, sf_dir, "pages").select("url")
    found = links.crawl_depth(corpus.chain_edges(spark, sf_dir), seeds)
    return found.select("url", F.col("depth").cast("long").alias("depth"))


@query
def robots_sitemaps(spark, sf_dir):
    return sitemaps.robots_sitemaps(corpus.robots_responses(spark, sf_dir))


@query
def sitemap_children(spark, sf_dir):
    parsed = sitemaps.parsed_sitemaps(corpus.sitemap_responses(spark, sf_dir))
    return sitemaps.sitemap_children(parsed)


@query
def sitemap_urls(spark, sf_dir):
    parsed = sitemaps.parsed_sitemaps(corpus.sitemap_responses(spark, sf_dir))
    return sitemaps.sitemap_urls(parsed, [r"/[a-z]"]).select("seq", "source_url", "target_url")


# --- frontier ----------------------------------------------------------------------------


@query
def frontier_state(spark, sf_dir):
    return fr.frontier_state(corpus.frontier(spark, sf_dir))


@query
def frontier_aliases(spark, sf_dir):
    return fr.frontier_aliases(corpus.frontier(spark, sf_dir))


@query
def frontier_reconcile(spark, sf_dir):
    return fr.reconcile_aliases(corpus.frontier(spark, sf_dir))


@query
def frontier_expand_aliases(spark, sf_dir):
    found = fr.page_identities(corpus.responses(spark, sf_dir)).select("url").distinct()
    return fr.expand_aliases(found, corpus.frontier(spark, sf_dir))


@query
def page_identities(spark, sf_dir):
    return fr.page_identities(corpus.responses(spark, sf_dir))


def _outcomes(spark, sf_dir):
    options = ImportOptions(url_filter=URL_PATTERNS)
    return response_outcomes(corpus.documents(spark, sf_dir), options)


@query
def frontier_outcomes(spark, sf_dir):
    known = corpus.frontier(spark, sf_dir)
    settled = _outcomes(spark, sf_dir).where(F.col("outcome").isNotNull())
    events = fr.expand_aliases(fr.outcome_events(settled), known)
    rows = fr.frontier_rows(events, corpus.SEED_STAMP)
    return fr.carry_discovery(known, rows.drop("seq"))


@query
def frontier_upsert(spark, sf_dir):
    known = corpus.frontier(spark, sf_dir)
    seeds = corpus.table(spark, sf_dir, "pages").select(
        urls.canonical_url(F.concat("url", F.lit("/more"))).alias("url")
    )
    rows = fr.insert_seeds(known, seeds, corpus.SEED_STAMP)
    settled = corpus.documents(spark, sf_dir).select(
        "url", F.when(filters.has_failed(), "failed").otherwise("done").alias("status"), "seq"
    )
    updates = fr.frontier_rows(settled, corpus.SEED_STAMP)
    return fr.upsert_frontier(known, updates.unionByName(rows.withColumn("seq", F.lit(-1).cast("long"))))


@query
def unresolved_seeds(spark, sf_dir):
    pages = corpus.table(spark, sf_dir, "pages")
    seeds = pages.select(
        urls.canonical_url(F.concat("url", F.when(F.col("page_id") % 2 == 0, "/x").otherwise(""))).alias("url")
    )
    return fr.unresolved_seeds(seeds, fr.page_identities(corpus.responses(spark, sf_dir)))


@query
def resume_worklist(spark, sf_dir):
    return fr.resume_worklist(corpus.frontier(spark, sf_dir), True, [r"/(en|de)/"])


# --- runs, streams -----------------------------------------------------------------------


@query
def import_summary(spark, sf_dir):
    return plan_import(corpus.responses(spark, sf_dir)).summary()


@query
def outcomes_by_host(spark, sf_dir):
    return metrics.outcomes_by_host(_outcomes(spark, sf_dir))


def _captured(spark, sf_dir, parts: int) -> str:
    path = new_workspace(spark, "captured")
    corpus.responses(spark, sf_dir).repartitionByRange(parts, "seq").write.parquet(path)
    return path


@query
def stream_ingest(spark, sf_dir):
    """Responses from files, drained in micro-batches into a page table."""
    source = stream_responses(spark, _captured(spark, sf_dir, 3), max_files_per_trigger=1)
    table = new_workspace(spark, "ingest")
    options = ImportOptions(content_format="text", strip="scripts,image-data-urls", optimize_every=None)
    start_ingest(spark, source, table, options, available_now=True).awaitTermination()
    return KeyedTable(spark, table, "url").current().select("url", "date", "content_type", "text")


@query
def stream_resume(spark, sf_dir):
    """A second run goes on from the checkpoint of the first; the URL states at the end."""
    path, table = _captured(spark, sf_dir, 2), new_workspace(spark, "resume")
    options = ImportOptions(content_format="html", strip="none", optimize_every=None)
    for half in ("part-00000*", "part-*"):
        source = spark.readStream.schema(spark.read.parquet(path).schema)
        source = source.option("pathGlobFilter", half).parquet(path)
        start_ingest(spark, source, table, options, available_now=True).awaitTermination()
    return KeyedTable(spark, f"{table}__frontier", "url").current().select("url", "status")


_TEXT = {"content_format": "text", "strip": "scripts,image-data-urls", "optimize_every": None}


@query
def import_seeded(spark, sf_dir):
    """A resumed import over stored URL states; the states afterwards."""
    table = new_workspace(spark, "seeded")
    pages = corpus.table(spark, sf_dir, "pages")
    gone = pages.select(F.concat(urls.url_origin(F.col("url")), F.lit("/gone/"), "page_id").alias("url"))
    gone = fr.frontier_rows(gone.withColumn("status", F.lit("pending")), corpus.SEED_STAMP)
    states = KeyedTable(spark, f"{table}__frontier", "url", "status")
    states.append(corpus.frontier(spark, sf_dir).unionByName(gone))
    run_import(spark, corpus.responses(spark, sf_dir), table, resume=True, **_TEXT)
    return states.current()


@query
def import_sitemap(spark, sf_dir):
    """An import that takes robots files and sitemaps from among the responses; the URL states."""
    table = new_workspace(spark, "mapped")
    pages = corpus.table(spark, sf_dir, "pages").select("url").distinct()
    states = KeyedTable(spark, f"{table}__frontier", "url", "status")
    states.append(fr.frontier_rows(pages.withColumn("status", F.lit("pending")), corpus.SEED_STAMP))
    given = corpus.responses(spark, sf_dir).unionByName(corpus.captured_sitemaps(spark, sf_dir))
    run_import(spark, given, table, resume=True, include_sitemap=True, **_TEXT)
    return states.current().select("url", "status")


@query
def import_schema(spark, sf_dir):
    """Two imports into one table: an extractor with a schema of its own, then page records."""
    table = new_workspace(spark, "evolving")
    given = corpus.responses(spark, sf_dir)

    def titles(documents: DataFrame) -> DataFrame:
        title = F.regexp_extract(F.col("body").cast("string"), "(?s)<title>(.*?)</title>", 1)
        return documents.select("seq", "url", title.alias("title")).where("seq % 2 = 0")

    wanted = T.StructType.fromDDL("url string, title string, rating double")
    run_import(spark, given, table, extract=titles, schema=wanted, optimize_every=1)
    run_import(spark, given.where("seq % 3 = 0"), table, **_TEXT)
    return KeyedTable(spark, table, "url").current().select("url", "title", "rating", "content_type", "text")


@query
def import_write_failed(spark, sf_dir):
    """An import whose page table storage refuses; the URL states say so."""
    table = new_workspace(spark, "refused")
    # A file stands where the table has its batches.
    block = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/log")
    block.getFileSystem(spark._jsc.hadoopConfiguration()).create(block).close()
    run_import(spark, corpus.responses(spark, sf_dir), table, resume=True, write_waits=(0,), **_TEXT)
    states = KeyedTable(spark, f"{table}__frontier", "url").current()
    return states.select("url", "status", "error", "failure_type")


@query
def import_progress(spark, sf_dir):
    """The stages of an import and what each counted."""
    seen = []
    run_import(spark, corpus.responses(spark, sf_dir), new_workspace(spark, "watched"), resume=True,
               progress=seen.append, **_TEXT)
    rows = [(p.stage, p.rows, p.imported_records) for p in seen]
    return spark.createDataFrame(rows, "stage string, rows long, imported long")


@query
def import_cleaned(spark, sf_dir):
    """Two imports whose texts lose the blocks that all pages of their host so far repeat."""
    table = new_workspace(spark, "cleaned")
    given = corpus.responses(spark, sf_dir)
    for half in (0, 1):
        run_import(spark, given.where(F.col("seq") % 2 == half), table, drop_boilerplate=True, **_TEXT)
    return KeyedTable(spark, table, "url").current().select("url", "text")
