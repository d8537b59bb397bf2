"""What a keyed table reads, rewrites and keeps."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pagemill.operators import frontier as fr
from pagemill.sources import tables
from pagemill.sources.tables import KeyedTable


def rows(spark, *values):
    return spark.createDataFrame(list(values), "url string, text string")


def pages(spark, numbers, text="first"):
    return spark.createDataFrame([(f"https://h.com/{n}", text) for n in numbers], "url string, text string")


def files(path, pattern="base/*/*/*/*.parquet"):
    return {(name, os.stat(name).st_mtime_ns) for name in glob.glob(f"{path}/{pattern}")}


def buckets_of(table, df):
    return {row[0] for row in table._bucketed(df, *table._layout()).select("_bucket").collect()}


def content(df):
    return sorted(map(tuple, df.collect()))


def test_a_fold_leaves_untouched_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, "url", buckets=8)
    table.append(pages(spark, range(200)))
    table.compact()
    before = files(path)
    update = pages(spark, [3, 4], "second")
    table.append(update)
    touched = buckets_of(table, update)
    expected = content(table.current())
    assert table.maybe_compact(1) is False, "two rows are no fifth of any bucket"
    table.compact()
    assert before <= files(path)
    written = {name for name, _ in files(path) - before}
    assert {int(name.split("_bucket=")[1].split("/")[0]) for name in written} == touched
    assert content(table.current()) == expected and table.rows_since_fold() == 0
    assert len(expected) == 200 and sum(text == "second" for _, text in expected) == 2
    table.expire(keep=1)
    kept = {int(name.split("_bucket=")[1].split("/")[0]) for name, _ in files(path) & before}
    assert kept == set(range(8)) - touched and content(table.current()) == expected


def test_only_due_buckets_are_folded_and_the_rest_is_still_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, "url", buckets=4)
    table.append(pages(spark, range(100)))
    assert table.maybe_compact(100)
    grown = buckets_of(table, pages(spark, [7]))
    many = [n for n in range(1_000, 1_400) if n % 1 == 0]
    wanted = pages(spark, many, "new").where("url <> ''")
    inside = table._bucketed(wanted, *table._layout()).where(F.col("_bucket").isin(*grown)).select("url", "text")
    other = pages(spark, [5], "changed")
    table.append(inside.unionByName(other).dropDuplicates(["url"]))
    expected = content(table.current())
    assert table.maybe_compact(2)
    folded = {bucket for bucket, folds in table._folds().items() if len(folds) == 2}
    assert folded == grown or folded == grown | buckets_of(table, other) & grown
    assert content(table.current()) == expected
    monkeypatch.setattr(tables, "FOLD_BATCHES", 1)
    table.maybe_compact(1)
    assert table.rows_since_fold() == 0 and content(table.current()) == expected


def test_folds_amid_replays(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url", buckets=3)
    for batch in range(6):
        update = pages(spark, range(batch, batch + 30), f"b{batch}")
        table.append(update, batch)
        before = content(table.current(before=batch)) if batch else []
        expected = content(table.current())
        assert table.maybe_compact(1)
        assert content(table.current()) == expected
        # The batch comes again: it sees the table as it was and changes nothing.
        assert (content(table.current(before=batch)) if batch else []) == before
        table.append(update, batch)
        assert content(table.current()) == expected
    assert len(table.batches()) <= 3


def test_a_write_without_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url", buckets=2)
    nothing = pages(spark, [1]).where("false")
    table.append(nothing)
    assert table.current().count() == 0 and table.schema().names == ["url", "text"]
    assert not table.maybe_compact(1) and table.compact() is None
    table.append(pages(spark, [1]).withColumn("more", F.lit(1)))
    table.append(nothing)
    assert content(table.current()) == [("https://h.com/1", "first", 1)]
    assert table.current().columns == ["url", "text", "more"]


def test_unfinished_writes_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, "url", buckets=2)
    table.append(pages(spark, [1]))
    table.append(pages(spark, [1, 2], "lost"))
    os.remove(f"{path}/log/batch_id=1/_SUCCESS")
    assert content(table.current()) == [("https://h.com/1", "first")] and table.next_batch() == 1
    table.compact()
    table.append(pages(spark, [2]))
    table.compact()
    os.remove(f"{path}/base/fold=1/_SUCCESS")
    assert len(content(table.current())) == 2


def scans(df):
    """(files read, rows read) of the table scans of a finished query."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            found.append((metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert found, text
    return found


def run(df):
    df._jdf.queryExecution().executedPlan().executeCollect()
    return df


def test_a_lookup_skips_buckets_and_row_groups(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url", buckets=4)
    spark.conf.set("parquet.block.size", "20000")
    try:
        wide = spark.range(20_000).select(
            F.concat(F.lit("https://h.com/"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("url"),
            F.md5(F.col("id").cast("string")).alias("text"),
        )
        table.append(wide)
        table.compact()
    finally:
        spark.conf.unset("parquet.block.size")
    found = run(table.lookup(["https://h.com/000123", "https://h.com/019999", "https://h.com/none"]))
    read = scans(found)
    assert sum(files for files, _ in read) <= 3
    assert sum(rows for _, rows in read) < 20_000 / 4
    assert {r.url for r in found.collect()} == {"https://h.com/000123", "https://h.com/019999"}
    assert KeyedTable(spark, str(tmp_path / "none"), "url").lookup(["x"]) is None


def test_a_slice_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "f")
    table = KeyedTable(spark, path, "url", "status", buckets=16)
    urls = [f"https://h.com/{n}" for n in range(300)] + ["https://h.com/7#part", "HTTPS://H.com/7"]
    base = spark.createDataFrame([(u, "pending") for u in urls], "url string, status string")
    table.append(fr.frontier_rows(base, "2025-01-01T00:00:00Z"))
    table.compact()
    keys = spark.createDataFrame([("https://h.com/7",), ("https://h.com/unknown",)], "url string")
    part = table.slice(keys)
    assert {r.url for r in part.collect()} == {"https://h.com/7", "https://h.com/7#part", "HTTPS://H.com/7"}
    part = run(table.slice(keys))
    assert sum(rows for _, rows in scans(part)) < 300 / 4
    assert table.slice(keys.where("false")).count() == 0


def test_keys_that_are_no_urls(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=3, rows_per_file=2)
    table.append(spark.range(10).withColumn("n", F.lit(1)))
    table.append(spark.range(5, 15).withColumn("n", F.lit(2)))
    table.compact()
    assert content(table.current()) == [(i, 1 if i < 5 else 2) for i in range(15)]
    assert content(table.lookup([3, 14, 99])) == [(3, 1), (14, 2)]
    assert content(table.slice(spark.range(2, 6))) == [(2, 1), (3, 1), (4, 1), (5, 2)]
    assert all(len(spark.read.parquet(name).collect()) <= 2 for name, _ in files(table.path))


@pytest.mark.parametrize("name", ["a b", "x[1]", "q{2}*"])
def test_odd_folder_names(spark, tmp_path, name):
    table = KeyedTable(spark, str(tmp_path / name), "url", buckets=2)
    table.append(pages(spark, [1]))
    assert table.batches() == [0]
