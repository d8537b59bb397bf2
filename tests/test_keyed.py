import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators import batches, filters, keyed, schema
from pagemill.operators.records import record_bytes
from pagemill.operators.skew import lookup_join
from pagemill.sources.tables import KeyedTable


def test_keep_last_and_upsert(spark):
    updates = spark.createDataFrame(
        [("a", "First", 1), ("b", "B", 2), ("a", "Second", 3)], "url string, text string, seq long"
    )
    stored = spark.createDataFrame([("b", "old"), ("c", "C")], "url string, text string")
    merged = keyed.upsert(stored, updates, "url", "seq")
    assert {(r.url, r.text) for r in merged.collect()} == {("a", "Second"), ("b", "B"), ("c", "C")}
    again = keyed.upsert(merged, updates, "url", "seq")
    assert sorted(again.collect()) == sorted(merged.collect())


def test_schema_evolution(spark):
    old = T.StructType([T.StructField("url", T.StringType()), T.StructField("a", T.LongType())])
    new = spark.createDataFrame([("u", None, "x")], "url string, b void, c string")
    merged = schema.merge_schema(old, new.schema, "url")
    assert merged.names == ["url", "a", "b", "c"]
    assert merged["b"].dataType == T.StringType()
    assert schema.conform(new, merged).first().asDict() == {"url": "u", "a": None, "b": None, "c": "x"}
    with pytest.raises(ValueError, match="primary key"):
        schema.merge_schema(None, new.schema, "id")
    with pytest.raises(TypeError, match="'a' is string"):
        schema.conform(spark.createDataFrame([("u", "1")], "url string, a string"), merged)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_hot_key(spark, how):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 1, None)
        .otherwise((F.col("id") % 50).cast("string")).alias("key"), "id",
    )
    one = spark.createDataFrame([("hot", 1, "h"), *((str(i), i, None) for i in range(40))], "key string, n int, m string")
    got = lookup_join(many, one, "key", how=how, hot_keys=2, hot_rows=100)
    expected = many.join(one, "key", how).select("key", "id", "n", "m")
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_write_batches(spark, tmp_path):
    dice = random.Random(4)
    data = [("hot" if dice.random() < 0.4 else dice.choice("abc"), seq, dice.randrange(90)) for seq in range(400)]
    df = spark.createDataFrame(data, "host string, seq long, octets long").repartition(5)
    for rows in (1, 7, 1000):
        path = str(tmp_path / str(rows))
        batches.write_batches(df, path, "host", rows)
        stored = spark.read.parquet(path)
        assert sorted(map(tuple, stored.select("host", "seq", "octets").collect())) == sorted(data)
        for row in batches.batch_files(stored, "host", "octets").collect():
            own = [octets for host, _, octets in data if host == row.host]
            assert (row.rows, row.octets, row.largest) == (len(own), sum(own), min(rows, len(own)))


def test_record_bytes(spark):
    df = spark.createDataFrame(
        [("é", True, 1.5, None, [("s", None)], {"k": "vv"})],
        "a string, b boolean, c double, d string, e array<struct<src:string,alt:string>>, f map<string,string>",
    )
    assert df.select(record_bytes(df)).first()[0] == 6 + 2 + 1 + 8 + 0 + (6 + 1) + 3


@pytest.mark.parametrize(("cuts", "piece"), [(4, 3), (256, 10_000)])
def test_limit(spark, monkeypatch, cuts, piece):
    monkeypatch.setattr(filters, "CUTS", cuts)
    monkeypatch.setattr(filters, "SLICE", piece)
    values = [i * 70_001 % 900_001 - 500 for i in range(400)] + [(1 << 62) + i * (1 << 40) for i in range(100)]
    pages = spark.createDataFrame([(v,) for v in values], "seq long").cache()
    for limit in (1, 37, 399, 450, 500, 700):
        got = sorted(r.seq for r in filters.limit_pages(pages, limit).collect())
        assert got == sorted(values)[:limit]
    assert filters.limit_pages(pages, 0).count() == 0
    assert filters.limit_pages(pages, None).count() == 500


def test_no_task_of_the_limit_gets_all_values(spark, monkeypatch):
    monkeypatch.setattr(filters, "SLICE", 100)
    sorted_sizes = []
    values = spark.range(200_000).select((F.xxhash64("id")).alias("value"))
    expected = sorted(r.value for r in values.collect())

    original = type(values).orderBy

    def watch(self, *columns):
        sorted_sizes.append(self.count())
        return original(self, *columns)

    monkeypatch.setattr(type(values), "orderBy", watch)
    for n in (1, 77_777, 200_000):
        assert filters.nth_value(values, n) == expected[n - 1]
    assert filters.nth_value(values, 200_001) is None
    assert max(sorted_sizes) <= 100


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "url", "status", buckets=1)
    assert table.current() is None

    def rows(*values):
        return spark.createDataFrame(list(values), "url string, status string")

    table.append(rows(("a", "x"), ("b", "x")))
    table.append(rows(("b", "y"), ("c", "x")).selectExpr("url", "status", "1L AS n"))
    expected = {("a", "x", None), ("b", "y", 1), ("c", "x", 1)}
    read = lambda before=None: {tuple(r) for r in table.current(before).select("url", "status", "n").collect()}
    assert read() == expected
    assert not table.maybe_compact(None) and not table.maybe_compact(5)
    assert table.maybe_compact(4)
    assert table.rows_since_fold() == 0 and read() == expected
    table.append(rows(("a", "z")), batch_id=2)
    table.append(rows(("a", "z"), ("d", "z")), batch_id=2)
    assert read() == (expected - {("a", "x", None)}) | {("a", "z", None), ("d", "z", None)}
    assert read(before=2) == expected
    assert {tuple(r) for r in table.current(before=1).collect()} == {("a", "x"), ("b", "x")}
    table.compact()
    table.append(rows(("e", "z")))
    table.compact()
    kept = read()
    table.expire(keep=2)
    assert table.bases() == [2, 3] and table.batches() == [3] and read() == kept
    plan = table.current().where("status = 'z'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan


def one_writer(sizes, rows, octets):
    marks, batch, count, held = [], 0, 0, 0
    for size in sizes:
        over = octets is not None and held is not None and size is not None and held + size > octets
        if count and over:
            batch, count, held = batch + 1, 0, 0
        marks.append(batch)
        count, held = count + 1, None if held is None or size is None else held + size
        if count >= rows:
            batch, count, held = batch + 1, 0, 0
    return marks


@pytest.mark.parametrize(
    ("rows", "octets", "part"),
    [(4, 50, 8), (100, 60, 16), (3, None, 8), (1, 1, 32), (7, 1000, 4), (9, 90, 40), (100, 90, 1), (5, 40, 10**6)],
)
def test_number_batches_equal_one_writer(spark, rows, octets, part):
    dice = random.Random(rows)
    sizes = [0, 1, 5, 12, 30, 75] + ([None] if rows in (4, 9, 5, 100) else [])
    data = [
        ("hot" if dice.random() < 0.5 else dice.choice(["a", "b", "c", "d", "", None]), seq, dice.choice(sizes))
        for seq in range(300)
    ]
    df = spark.createDataFrame(data, "host string, seq long, record_bytes long").repartition(3)
    got = batches.number_batches(df, "host", "seq", "record_bytes", rows, octets, part_rows=part)
    assert got.columns == ["host", "seq", "record_bytes", "batch"]
    found = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    assert [row[:3] for row in found] == data
    for host in {row[0] for row in data}:
        want = one_writer([size for name, _, size in data if name == host], rows, octets)
        assert [row[3] for row in found if row[0] == host] == want, host


def test_batches_go_on_from_one_arrow_batch_to_the_next(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        dice = random.Random(1)
        data = [(dice.choice(["a", "b", "hot", "hot"]), seq, dice.choice([5, 12, 30, None])) for seq in range(200)]
        df = spark.createDataFrame(data, "host string, seq long, record_bytes long")
        got = batches.number_batches(df, "host", "seq", "record_bytes", 10, 70, part_rows=50).collect()
    finally:
        spark.conf.set(name, before)
    assert len(got) == 200
    for host in ("a", "b", "hot"):
        want = one_writer([size for name, _, size in data if name == host], 10, 70)
        assert [row.batch for row in sorted(got, key=lambda r: r.seq) if row.host == host] == want


def test_one_host_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """The files of a host follow each other by ``seq`` and are dealt over tasks."""
    monkeypatch.setattr(batches, "TASK_FILES", 5)
    path = str(tmp_path / "files")
    df = spark.range(203).selectExpr("'one' AS host", "(id * 37) % 203 AS seq")
    batches.write_batches(df, path, "host", 4)
    files = {}
    for row in spark.read.parquet(path).select("seq", "_metadata.file_name").collect():
        files.setdefault(row.file_name, []).append(row.seq)
    assert sorted(map(sorted, files.values())) == [list(range(a, min(a + 4, 203))) for a in range(0, 203, 4)]
    tasks = [name.split("-")[1] for name in files]
    assert len(set(tasks)) > 5 and max(map(tasks.count, tasks)) < 25
