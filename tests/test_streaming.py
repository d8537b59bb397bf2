import re
import time

import pytest
from pyspark.sql import functions as F

from builders import response, responses
from pagemill.operators.search import TermIndex
from pagemill.plans import corpus
from pagemill.plans.importing import plan_import
from pagemill.schemas import ImportOptions
from pagemill.session import finished_numbers
from pagemill.sources.responses import read_responses, stream_responses
from pagemill.sources.tables import KeyedTable
from pagemill.streaming.ingest import micro_batch_writer, start_ingest

OPTIONS = ImportOptions(content_format="html", strip="none", optimize_every=6)


def captured(spark, path, *batches):
    for rows in batches:
        responses(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def rows(*numbers):
    body = '<a href="/{0}">n</a><a href="/late">l</a>'
    return [response(n, f"https://h.com/{n}", body.format(n + 1)) for n in numbers]


def drain(spark, source, table, files=1):
    stream = stream_responses(spark, source, max_files_per_trigger=files)
    query = start_ingest(spark, stream, table, OPTIONS, available_now=True)
    query.awaitTermination()
    return query


def view(spark, table):
    pages = KeyedTable(spark, table, "url").current().select("url", "text")
    states = KeyedTable(spark, f"{table}__frontier", "url").current().select("url", "status")
    return sorted(map(tuple, pages.collect())), sorted(map(tuple, states.collect()))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "pages")
    again = [{**rows(2)[0], "seq": 12}]
    captured(spark, source, rows(1, 2), rows(3), again + rows(4))
    drain(spark, source, table)
    captured(spark, source, rows(6), rows(7))
    query = drain(spark, source, table)
    assert len(query.recentProgress) >= 2
    plan = plan_import(read_responses(spark, source), OPTIONS)
    pages, states = view(spark, table)
    assert pages == sorted(map(tuple, plan.records.select("url", "text").collect()))
    assert states == sorted(map(tuple, plan.frontier_updates.select("url", "status").collect()))
    assert KeyedTable(spark, table, "url").bases()
    first = KeyedTable(spark, f"{table}__frontier", "url").current().where(F.col("url").endswith("/late"))
    assert first.first().source_url == "https://h.com/1"


def test_replay_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "pages")
    write = micro_batch_writer(spark, table, OPTIONS)
    batches = [responses(spark, *rows(1, 2)), responses(spark, *rows(3, 4)), responses(spark, *rows(5))]
    for epoch, batch in enumerate(batches):
        write(batch, epoch)
        before = view(spark, table)
        write(batch, epoch)
        assert view(spark, table) == before
    assert len(before[0]) == 5


def test_stream_after_batch_import(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "pages")
    KeyedTable(spark, table, "url").append(
        spark.createDataFrame([("https://h.com/0", "kept")], "url string, text string")
    )
    captured(spark, source, rows(1))
    drain(spark, source, table)
    assert ("https://h.com/0", "kept") in view(spark, table)[0]


def test_corpus_covers_all_pages(spark):
    path = "/root/testdata/sf0.001"
    assert corpus.responses(spark, path).count() == corpus.table(spark, path, "pages").count()


def test_timed_batches_and_bytes(spark, tmp_path):
    """Two arrivals with time between them are two batches; a folder larger than the bound too."""
    source, table = str(tmp_path / "in"), str(tmp_path / "pages")
    captured(spark, source, rows(1))
    seen = []
    options = ImportOptions(content_format="html", strip="none", max_batch_delay=1)
    query = start_ingest(spark, source, table, options, progress=seen.append)
    try:
        assert wait(lambda: sum(p.stage == "completed" for p in seen) == 1)
        captured(spark, source, rows(3), rows(5))
        assert wait(lambda: sum(p.result.imported_records for p in seen if p.stage == "completed") == 3)
        progress = [p for p in query.recentProgress if p.numInputRows]
        assert [p.numInputRows for p in progress][0] == 1 and sum(p.numInputRows for p in progress) == 3
        assert 2 <= len(progress) <= 3 and query.lastProgress is not None
    finally:
        query.stop()
    stages = [p.stage for p in seen]
    assert stages[:5] == ["started", "page_scraped", "record_extracted", "batch_merged", "frontier_discovered"]
    size = max(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    small = ImportOptions(content_format="html", strip="none", max_batch_bytes=size)
    query = start_ingest(spark, source, f"{table}2", small, available_now=True)
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1, 1, 1]
    assert view(spark, f"{table}2") == view(spark, table)
    with pytest.raises(ValueError, match="max_batch_bytes"):
        start_ingest(spark, stream_responses(spark, source), f"{table}3", small)


def wait(done, seconds=60):
    deadline = time.time() + seconds
    while time.time() < deadline and not done():
        time.sleep(0.2)
    return done()


def test_index_of_a_stream_drops_replaced_terms(spark, tmp_path):
    table = str(tmp_path / "pages")
    options = ImportOptions(content_format="text", strip="none", index_columns=("text",))
    write = micro_batch_writer(spark, table, options)
    write(responses(spark, response(1, "https://h.com/1", "<p>red fox</p>"), response(2, "https://h.com/2", "<p>fox</p>")), 0)
    again = responses(spark, response(3, "https://h.com/1", "<p>blue fox fox</p>"))
    for _ in range(2):
        write(again, 1)
    index = TermIndex(spark, f"{table}__terms", "url")
    expected = {("fox", "https://h.com/2", 1), ("blue", "https://h.com/1", 1), ("fox", "https://h.com/1", 2)}
    assert {tuple(r) for r in index.postings().collect()} == expected
    assert [r.url for r in index.search("fox", top=1).collect()] == ["https://h.com/1"]
    assert index.search(["red"]).count() == 0
    index.merge()
    assert {tuple(r) for r in index.postings().collect()} == expected
    write(responses(spark, response(4, "https://h.com/3", "<p>sea</p>")), 2)
    assert {tuple(r) for r in index.postings().collect()} == expected | {("sea", "https://h.com/3", 1)}
    found = index.live(index.stored().where(F.col("term").isin(["sea"])))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(term", plan)


def test_index_batches_are_merged_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TermIndex, "MERGE_SHARE", 10.0)
    monkeypatch.setattr(TermIndex, "MERGE_BATCHES", 3)
    index = TermIndex(spark, str(tmp_path / "terms"), "id")
    for batch in range(5):
        docs = spark.createDataFrame([(i, f"w{batch} all") for i in range(batch, batch + 3)], "id long, text string")
        index.append(docs, batch)
    last = {i: min(i, 4) for i in range(7)}
    assert {tuple(r) for r in index.postings().collect()} == {
        row for i, b in last.items() for row in ((f"w{b}", i, 1), ("all", i, 1))
    }
    assert len(finished_numbers(spark, index.path, "merged/upto")) >= 1
    assert len(finished_numbers(spark, index.path, "postings/batch_id")) <= 4
