"""What the physical plans must and must not hold."""

import re

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = spark_entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    from pagemill.plans.oracles import ORACLES
    from pagemill.plans.queries import REGISTRY

    assert set(ORACLES) == set(REGISTRY) <= set(spark_entry.queries())


@pytest.mark.parametrize(
    "name",
    ["page_records", "page_records_html", "html_markdown", "strip_html", "page_images", "link_edges",
     "clean_pages", "text_postings", "frontier_outcomes", "sitemap_urls"],
)
def test_no_python_workers(spark, name):
    plan = plan_of(spark, name)
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name", ["frontier_outcomes", "frontier_state", "outcomes_by_host", "url_domain", "unresolved_seeds"]
)
def test_url_queries_do_not_read_html(spark, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(spark, name))
    assert schemas and not any("html" in schema for schema in schemas)


def test_outcomes_need_no_join(spark):
    assert "Join" not in plan_of(spark, "outcomes_by_host")


def test_flagship_matches_its_sql(spark):
    ours = spark_entry.entry(spark).toArrow()
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    theirs = engine.execute(spark_entry.oracle_sql()["page_records"]).to_arrow_table()
    names = sorted(ours.column_names)
    assert names == sorted(theirs.column_names)
    assert sorted(map(repr, ours.select(names).to_pylist())) == sorted(
        map(repr, theirs.select(names).to_pylist())
    )
