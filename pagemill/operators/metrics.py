"""Counters of an import run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.urls import url_domain


def import_summary(
    outcomes: DataFrame,
    imported: DataFrame,
    discovered: DataFrame | None = None,
    unresolved: DataFrame | None = None,
) -> DataFrame:
    """One row with the six counters of a run.

    ``outcomes`` has one row per response; ``imported`` one row per stored key.  A page
    that was read counts as matched.
    """
    read = F.count_if(F.col("outcome").isin("done", "skipped"))
    counted = outcomes.agg(
        read.alias("matched_records"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_records"),
        read.alias("pages_read"),
        F.count_if(F.col("outcome") == "failed").alias("_failed"),
    )

    def rows(df: DataFrame | None):
        return F.lit(0).cast("long") if df is None else df.agg(F.count("*")).scalar()

    return counted.select(
        "matched_records",
        rows(imported).alias("imported_records"),
        "skipped_records",
        "pages_read",
        rows(discovered).alias("discovered_urls"),
        (F.col("_failed") + rows(unresolved)).alias("failed_urls"),
    )


def outcomes_by_host(outcomes: DataFrame) -> DataFrame:
    """``host, outcome, responses`` with totals per host and overall (NULL marks a total)."""
    named = outcomes.select(
        url_domain(F.col("url")).alias("host"), F.coalesce("outcome", F.lit("unmatched")).alias("outcome")
    )
    return named.rollup("host", "outcome").agg(F.count("*").alias("responses"))
