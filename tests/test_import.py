import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from builders import PAGE, response, responses
from pagemill.operators import frontier as fr
from pagemill.operators.search import TermIndex
from pagemill.operators.records import page_records, pandas_extractor
from pagemill.plans import importing
from pagemill.plans.importing import ImportResult, plan_import, run_import
from pagemill.schemas import FRONTIER_SCHEMA, ImportOptions
from pagemill.sources.responses import read_responses, response_documents
from pagemill.sources.tables import KeyedTable
from pagemill.streaming.ingest import micro_batch_writer


def frontier(spark, *rows):
    base = spark.createDataFrame([(u, s) for u, s in rows], "url string, status string")
    return fr.frontier_rows(base, "2025-01-01T00:00:00Z")


def states(df):
    return {r.url: r.status for r in df.select("url", "status").collect()}


def stored(spark, path):
    return states(KeyedTable(spark, path, "url").current())


def test_default_record(spark):
    row = page_records(
        response_documents(responses(spark, response(1, "https://example.com/a"))),
        ImportOptions(strip="none"),
    ).first()
    assert (row.text, row.images, row.date) == ("Hello **A**\n", [], "2026-01-01T00:00:01Z")
    assert row.content_type == "text/html; charset=utf-8"


@pytest.mark.parametrize(
    ("clean", "images", "menu"),
    [
        ("before-links", ["/main.png"], False),
        ("after-links", ["/nav.png", "/main.png"], False),
        ("none", ["/nav.png", "/main.png"], True),
    ],
)
def test_clean_order(spark, clean, images, menu):
    body = (
        '<nav><a href="/n">Navigation</a><img src="/nav.png" alt="Nav"></nav>'
        '<article><h1>Main</h1><img src="/main.png" alt="Main"></article>'
    )
    docs = response_documents(responses(spark, response(1, "https://example.com/a", body)))
    row = page_records(docs, ImportOptions(clean=clean)).first()
    assert [i.src for i in row.images] == images
    assert ("Navigation" in row.text) == menu


def summary(spark, rows, **options):
    plan = plan_import(responses(spark, *rows), ImportOptions(**options))
    urls = sorted(r[options.get("primary_key", "url")] for r in plan.records.collect())
    return plan.summary().first().asDict(), urls


def test_filters(spark):
    rows = [
        response(1, "https://example.com/a"),
        response(2, "https://example.com/file.step", b"x", "application/octet-stream"),
    ]
    counts, urls = summary(spark, rows)
    assert (counts["matched_records"], counts["imported_records"], counts["skipped_records"]) == (2, 1, 1)
    assert urls == ["https://example.com/a"]
    assert summary(spark, rows, response_filter="url LIKE '%.step%'")[1] == ["https://example.com/file.step"]
    assert summary(spark, rows, response_filter="")[1] == urls
    assert summary(spark, rows, response_filter="headers['content-type'] LIKE '%text/html%'")[1] == urls
    assert summary(spark, rows, response_filter=F.col("missing_key").isNull() if False else F.lit(None))[1] == []


def test_last_response_of_a_url_wins(spark):
    rows = [response(1, "https://e.com/a", "<p>First</p>"), response(2, "https://e.com/a", "<p>Second</p>")]
    plan = plan_import(responses(spark, *rows))
    assert [r.text for r in plan.records.collect()] == ["Second\n"]
    counts = plan.summary().first()
    assert (counts.matched_records, counts.imported_records) == (2, 1)


def test_custom_extract(spark):
    rows = [response(1, "https://e.com/a", "<title>T</title>"), response(2, "https://e.com/b", "<p>no</p>")]

    def titles(documents):
        title = F.regexp_extract(F.col("body").cast("string"), "<title>(.*?)</title>", 1)
        return documents.select("seq", "url", title.alias("title")).where("title <> ''")

    def titles_in_pandas(batch):
        batch = batch.assign(title=batch.body.str.decode("utf-8").str.extract("<title>(.*?)</title>")[0])
        return batch.dropna(subset=["title"])[["seq", "url", "title"]]

    schema = "seq long, url string, title string"
    for extract in (titles, pandas_extractor(titles_in_pandas, schema)):
        plan = plan_import(responses(spark, *rows), ImportOptions(extract=extract))
        assert [tuple(r) for r in plan.records.select("url", "title").collect()] == [("https://e.com/a", "T")]
        counts = plan.summary().first()
        assert (counts.matched_records, counts.imported_records, counts.skipped_records) == (2, 1, 1)
    with pytest.raises(ValueError, match="primary key"):
        plan_import(responses(spark, *rows), ImportOptions(extract=titles, primary_key="id"))


def test_limit_counts_matching_pages(spark):
    rows = [response(i, f"https://e.com/{'x' if i % 2 else 'y'}/{i}") for i in range(8)]
    rows.append(response(9, "https://e.com/y/9", status=500))
    counts, urls = summary(spark, rows, url_filter="/x/", limit=2)
    assert urls == ["https://e.com/x/1", "https://e.com/x/3"]
    assert (counts["matched_records"], counts["failed_urls"]) == (2, 0)
    assert summary(spark, rows, url_filter="/x/", limit=50)[0]["failed_urls"] == 1
    assert summary(spark, rows, limit=0)[0]["matched_records"] == 0


def run(spark, tmp_path, rows, known=(), **settings):
    table = str(tmp_path / "pages")
    if known:
        KeyedTable(spark, f"{table}__frontier", "url").append(frontier(spark, *known))
    result = run_import(spark, responses(spark, *rows), table, resume=True, **settings)
    return result, stored(spark, f"{table}__frontier")


def test_discovery_and_done(spark, tmp_path):
    rows = [response(1, "https://example.com/", '<a href="/next">n</a><a href="https://o.org/x">o</a>')]
    result, found = run(spark, tmp_path, rows, url="example.com", index_columns=("text",))
    assert found == {"https://example.com/": "done", "https://example.com/next": "pending"}
    assert result == ImportResult(1, 1, 0, 1, 1, 0)
    table = str(tmp_path / "pages")
    row = KeyedTable(spark, f"{table}__frontier", "url").current().where("status = 'pending'").first()
    assert (row.source_url, row.discovered_at) == ("https://example.com/", "2026-01-01T00:00:01Z")
    assert TermIndex(spark, f"{table}__terms", "url").postings().where("term = 'n'").count() == 1
    stages = []
    again = run_import(
        spark, responses(spark, response(2, "https://example.com/next")), table, "example.com",
        resume=True, optimize_every=1, progress=lambda p: stages.append(p.stage),
    )
    assert again == ImportResult(1, 1, 0, 1, 0, 0)
    assert set(stored(spark, f"{table}__frontier").values()) == {"done"}
    assert stored_discovery(spark, table)["https://example.com/next"] == (
        "2026-01-01T00:00:01Z", "https://example.com/"
    )
    assert stages == [
        "loading_frontier", "frontier_loaded", "started", "page_scraped", "record_extracted", "batch_merged",
        "optimizing", "optimized", "optimizing", "optimized", "completed",
    ]


def stored_discovery(spark, table):
    rows = KeyedTable(spark, f"{table}__frontier", "url").current().collect()
    return {r.url: (r.discovered_at, r.source_url) for r in rows}


def test_redirects_mark_every_identity(spark, tmp_path):
    rows = [
        response(1, "https://www.example.com/", request_url="https://example.com/"),
        response(2, "https://example.com/new", request_url="https://example.com/mid",
                 redirects=["https://example.com/old.html"]),
    ]
    known = [("https://example.com/", "pending"), ("https://example.com/old.html", "pending")]
    result, found = run(spark, tmp_path, rows, known)
    assert set(found.values()) == {"done"} and len(found) == 5
    assert result.failed_urls == 0


def test_failures(spark, tmp_path):
    rows = [
        response(1, "https://example.com/", status=403),
        response(2, "https://example.com/t", error="timed out"),
    ]
    known = [(u, "pending") for u in ("https://example.com/", "https://example.com/t", "https://example.com/gone")]
    result, found = run(spark, tmp_path, rows, known)
    assert set(found.values()) == {"failed"}
    table = KeyedTable(spark, str(tmp_path / "pages__frontier"), "url").current()
    detail = {r.url: (r.error, r.failure_type, r.http_status, r.final_url) for r in table.collect()}
    assert detail == {
        "https://example.com/": ("HTTP 403", "http_status", 403, "https://example.com/"),
        "https://example.com/t": ("timed out", "TimeoutError", None, "https://example.com/t"),
        "https://example.com/gone": (
            "request finished without response callback", "crawler_no_callback", None, None
        ),
    }
    assert result.failed_urls == 3


def test_aliases(spark):
    known = frontier(
        spark,
        ("https://example.com/page", "done"), ("https://example.com/page#main", "pending"),
        ("https://example.com", "pending"), ("https://example.com/", "done"),
        ("https://example.com/f", "failed"), ("https://example.com/f#x", "pending"),
    )
    assert states(fr.frontier_state(known)) == {
        "https://example.com/page": "done", "https://example.com/": "done", "https://example.com/f": "failed"
    }
    assert states(fr.reconcile_aliases(known)) == {
        "https://example.com/page#main": "done", "https://example.com": "done"
    }
    assert fr.resume_worklist(known).count() == 0
    events = spark.createDataFrame([("https://example.com/f", "done")], "url string, status string")
    assert states(fr.expand_aliases(events, known)) == {
        "https://example.com/f": "done", "https://example.com/f#x": "done"
    }


def test_worklist(spark):
    known = frontier(spark, ("https://a/x", "failed"), ("https://b/x", "failed"), ("https://a/y", "pending"))
    def work(**kw):
        return [r.url for r in fr.resume_worklist(known, **kw).collect()]

    assert work() == ["https://a/y"]
    assert work(retry_failed=True, url_filter="^https://a/") == ["https://a/x", "https://a/y"]
    assert work(retry_failed=True, limit=1) == ["https://a/x"]


def test_refused_write_marks_failed(spark, tmp_path, monkeypatch):
    tries, original = [], KeyedTable.append

    def count(self, *given):
        tries.append(self.path)
        return original(self, *given)

    monkeypatch.setattr(KeyedTable, "append", count)
    rows = [response(1, "https://example.com/"), response(2, "https://example.com/b", b"", "image/png")]
    blocked = tmp_path / "pages"
    blocked.mkdir()
    (blocked / "log").write_text("a file where the table has its batches")
    result, found = run(spark, tmp_path, rows, [("https://example.com/", "pending")], write_waits=(0, 0))
    assert found == {"https://example.com/": "failed", "https://example.com/b": "skipped"}
    assert (result.imported_records, result.skipped_records) == (0, 2)
    assert [path.endswith("pages") for path in tries if not path.endswith("__frontier")] == [True] * 3


def test_other_failures_are_raised(spark, tmp_path, monkeypatch):
    def lost(self, *given):
        raise RuntimeError("java.io.IOException: a source could not be read")

    rows = [response(1, "https://example.com/")]
    monkeypatch.setattr(KeyedTable, "append", lost)
    with pytest.raises(RuntimeError, match="could not be read"):
        run(spark, tmp_path, rows)


def test_start_url_that_a_limit_left_unread_stays_pending(spark, tmp_path):
    rows = [response(1, "https://example.com/other", PAGE), response(2, "https://example.com/start", PAGE)]
    result, found = run(spark, tmp_path, rows, url="https://example.com/start", limit=1)
    assert result.imported_records == 1
    assert (found["https://example.com/other"], found["https://example.com/start"]) == ("done", "pending")


def test_frontier_shape(spark):
    known = frontier(spark, ("https://a/", "pending"))
    assert known.schema.names == FRONTIER_SCHEMA.names
    rows = fr.frontier_rows(spark.createDataFrame([("https://a/", "done", 3)], "url string, status string, seq long"), "now")
    kept = fr.upsert_frontier(known, rows).first()
    assert (kept.status, kept.discovered_at, kept.updated_at) == ("done", "2025-01-01T00:00:00Z", "now")
    assert fr.upsert_frontier(known, rows, replace_whole_row=True).first().discovered_at == "now"


def test_sitemap_run(spark, tmp_path):
    urlset = "<urlset><url><loc>https://example.com/a</loc></url><url><loc>https://o.org/b</loc></url></urlset>"
    rows = [
        response(1, "https://example.com/robots.txt", "Sitemap: /m.xml", "text/plain"),
        response(2, "https://example.com/m.xml", urlset, "application/xml"),
        response(3, "https://example.com/sitemap.xml", "", "application/xml", status=404),
        response(4, "https://example.com/", PAGE),
    ]
    result, found = run(spark, tmp_path, rows, url="https://example.com", include_sitemap=True)
    assert found == {"https://example.com/": "done", "https://example.com/a": "pending"}
    assert result == ImportResult(1, 1, 0, 1, 1, 0)


def test_rows_without_key_and_with_the_same_key(spark, tmp_path):
    def explode(documents):
        key = F.when(F.col("seq") != 2, F.col("url"))
        pieces = F.explode(F.array(F.lit("x"), F.lit("y")))
        return documents.select("seq", key.alias("url"), pieces.alias("part"), F.lit(1).alias("more"))

    rows = [response(1, "https://e.com/a"), response(2, "https://e.com/b")]
    plan = plan_import(responses(spark, *rows), ImportOptions(extract=explode))
    assert [r.url for r in plan.records.collect()] == ["https://e.com/a"]
    counts = plan.summary().first()
    assert (counts.imported_records, counts.skipped_records) == (1, 1)
    wanted = T.StructType([T.StructField("url", T.StringType(), False), T.StructField("title", T.StringType())])
    table = str(tmp_path / "pages")
    run_import(spark, responses(spark, *rows), table, options=ImportOptions(extract=explode, schema=wanted))
    assert KeyedTable(spark, table, "url").current().columns == ["url", "title", "part", "more"]


def test_sitemap_under_any_content_type(spark, tmp_path):
    urlset = "<urlset><url><loc>https://example.com/a</loc></url></urlset>"
    rows = [
        response(1, "https://example.com/sitemap.xml", urlset, "text/plain"),
        response(2, "https://example.com/", PAGE),
    ]
    _, found = run(spark, tmp_path, rows, url="https://example.com", include_sitemap=True)
    assert found == {"https://example.com/": "done", "https://example.com/a": "pending"}


def body_scans(df):
    """The parquet scans of a plan that read the body of a response."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "ReadSchema" in line and "body" in line]


def test_responses_are_read_and_extracted_once(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "captured")
    rows = [response(n, f"https://e.com/{n}", f'<title>T{n}</title><a href="/{n + 1}">n</a>') for n in range(1, 7)]
    responses(spark, *rows).write.parquet(source)
    calls = spark.sparkContext.accumulator(0)

    def titles(batch):
        calls.add(len(batch))
        title = batch.body.str.decode("utf-8").str.extract("<title>(.*?)</title>")[0]
        return batch.assign(title=title)[["seq", "url", "title"]]

    extract = pandas_extractor(titles, "seq long, url string, title string")
    plans, original = [], importing.ImportPlan._at_rest

    def watch(self, df, name):
        plans.append((name, len(body_scans(df))))
        return original(self, df, name)

    monkeypatch.setattr(importing.ImportPlan, "_at_rest", watch)
    table = str(tmp_path / "pages")
    captured = read_responses(spark, source)
    result = run_import(spark, captured, table, resume=True, extract=extract)
    assert calls.value == 6 and result == ImportResult(6, 6, 0, 6, 1, 0)
    assert plans == [("read", 1), ("extracted", 1)]
    plans.clear()
    result = run_import(spark, captured, f"{table}2", resume=True)
    assert plans == [("read", 1)] and result == ImportResult(6, 6, 0, 6, 1, 0)


def test_what_was_read_is_stored_narrow_and_removed(spark, tmp_path):
    rows = [response(1, "https://e.com/1", '<a href="/2">n</a><a href="https://o.org/">o</a>'),
            response(2, "https://e.com/x", b"x", "image/png"), response(3, "https://e.com/3", status=500)]
    plan = plan_import(responses(spark, *rows))
    assert plan.settle() == {"pages_read": 2, "filtered": 1, "failed": 1}
    assert "Python" not in plan.read._jdf.queryExecution().executedPlan().toString()
    stored = {r.seq: (r.outcome, r.record and r.record.text, r.links) for r in plan.read.collect()}
    assert stored == {
        1: ("done", "[n](/2)[o](https://o.org/)\n", ["https://e.com/2"]), 2: ("skipped", None, None),
        3: ("failed", None, None),
    }
    (folder,) = plan._folders
    assert os.path.isdir(folder)
    plan.release()
    assert not os.path.isdir(folder)


def test_the_default_plan_stays_on_the_jvm(spark):
    plan = plan_import(responses(spark, response(1, "https://e.com/1")))
    for df in (plan.records, plan.outcomes, plan.discovered, plan.frontier_updates, plan.read):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_one_read_of_the_stored_states(spark, tmp_path, monkeypatch):
    sliced, original = [], KeyedTable.current

    def watch(self, before=None, buckets=None, keys=None, hidden=False):
        sliced.append((self.path, buckets is not None))
        return original(self, before, buckets, keys, hidden)

    monkeypatch.setattr(KeyedTable, "current", watch)
    table = str(tmp_path / "pages")
    write = micro_batch_writer(spark, table, ImportOptions(buckets=64, optimize_every=None))
    write(responses(spark, response(1, "https://e.com/1", '<a href="/2">n</a>')), 0)
    sliced.clear()
    write(responses(spark, response(2, "https://e.com/2", '<a href="/3">n</a>')), 1)
    assert sliced == [(f"{table}__frontier", True)]
    assert states(KeyedTable(spark, f"{table}__frontier", "url").current()) == {
        "https://e.com/1": "done", "https://e.com/2": "done", "https://e.com/3": "pending"
    }


def test_stages_carry_counters(spark, tmp_path):
    rows = [response(1, "https://e.com/1", '<a href="/9">n</a>'), response(2, "https://e.com/2", b"", "image/png"),
            response(3, "https://e.com/3", status=500), response(4, "https://e.com/4", "<p>no title</p>")]

    def linked(documents):
        return documents.where(F.col("body").cast("string").contains("href")).select("seq", "url")

    seen = []
    run(spark, tmp_path, rows, extract=linked, progress=seen.append, optimize_every=None)
    assert [(p.stage, p.rows) for p in seen] == [
        ("loading_frontier", 0), ("frontier_loaded", 0), ("started", 0), ("page_scraped", 3), ("request_failed", 1),
        ("response_filtered", 1), ("record_skipped", 1), ("record_extracted", 1), ("batch_merged", 1),
        ("frontier_discovered", 1), ("completed", 0),
    ]
    by_stage = {p.stage: (p.matched_records, p.imported_records, p.skipped_records, p.pending_records) for p in seen}
    assert by_stage["page_scraped"] == (3, 0, 1, 0) and by_stage["record_extracted"] == (3, 0, 2, 1)
    assert by_stage["completed"] == (3, 1, 2, 0) and seen[-1].result == ImportResult(3, 1, 2, 3, 1, 1)


def test_counts_of_a_run_without_rows(spark, tmp_path):
    nothing = responses(spark, response(1, "https://e.com/1")).where("false")
    table = str(tmp_path / "none")
    assert run_import(spark, nothing, table, resume=True) == ImportResult(0, 0, 0, 0, 0, 0)
    assert run_import(spark, nothing, f"{table}2", url="e.com") == ImportResult(0, 0, 0, 0, 0, 1)


def test_rows_that_differ_only_in_a_map(spark, tmp_path):
    def twice(documents):
        kinds = F.explode(F.array(F.lit("b"), F.lit("a"), F.lit("c"))).alias("kind")
        found = documents.select("seq", "url", kinds)
        return found.select("seq", "url", F.create_map(F.lit("k"), "kind").alias("m"), F.lit(None).alias("note"))

    rows = [response(1, "https://e.com/a"), response(2, "https://e.com/a")]
    found = {
        tuple(plan_import(responses(spark, *rows).repartition(n), ImportOptions(extract=twice)).records.select("seq", "m.k").first())
        for n in (1, 2, 3)
    }
    assert len(found) == 1 and found.pop()[0] == 2


def test_an_index_column_the_rows_lack_fails_before_anything_is_written(spark, tmp_path):
    def keyed(documents):
        return documents.select("seq", "url", F.lit("x").alias("title"))

    table = str(tmp_path / "pages")
    with pytest.raises(ValueError, match="'text'"):
        run(spark, tmp_path, [response(1, "https://e.com/a")], extract=keyed, index_columns=("text",))
    assert not os.path.exists(table) and not os.path.exists(f"{table}__terms")


def test_lagging_spellings_are_raised_when_a_run_touches_their_url(spark, tmp_path):
    known = [("https://e.com/a", "done"), ("https://e.com/b#y", "pending"), ("https://e.com/b", "skipped")]
    rows = [response(1, "https://e.com/c", '<a href="/a">a</a>')]
    table = KeyedTable(spark, str(tmp_path / "pages__frontier"), "url")
    failed = frontier(spark, ("https://e.com/a#x", "failed")).withColumn("failure_type", F.lit(fr.UNANSWERED_TYPE))
    table.append(frontier(spark, *known).unionByName(failed))
    result, found = run(spark, tmp_path, rows)
    assert result.failed_urls == 0
    raised = table.current().where("url = 'https://e.com/a#x'").first()
    assert (raised.failure_type, raised.discovered_at) == (None, "2025-01-01T00:00:00Z")
    assert found == {"https://e.com/a": "done", "https://e.com/a#x": "done", "https://e.com/b": "skipped",
                     "https://e.com/b#y": "pending", "https://e.com/c": "done"}


def test_boilerplate_goes_from_the_text_of_an_import(spark, tmp_path):
    def pages_of(numbers):
        return [response(n, f"https://e.com/{n}", f"<p>Menu</p><p>Story {n}</p>") for n in numbers]

    plain = response(90, "https://e.com/plain", "Menu", "text/plain")
    table = str(tmp_path / "pages")
    options = {"content_format": "text", "drop_boilerplate": True}
    run_import(spark, responses(spark, *pages_of([1, 2])), table, **options)
    run_import(spark, responses(spark, *pages_of([3, 4]), plain, response(91, "https://e.com/m", "<p>Menu</p>")), table, **options)
    assert {r.url[14:]: r.text for r in KeyedTable(spark, table, "url").current().collect()} == {
        "1": "Menu\nStory 1", "2": "Menu\nStory 2", "3": "Story 3", "4": "Story 4", "plain": "Menu", "m": "Menu"
    }
    with pytest.raises(ValueError, match="drop_boilerplate"):
        ImportOptions(drop_boilerplate=True)
