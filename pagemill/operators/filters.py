"""Routing, filters and the page limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.content import is_textual
from pagemill.functions.urls import url_matches
from pagemill.session import cut_lineage

#: Parts into which a round of :func:`nth_value` cuts a range, and the size at which it sorts it.
CUTS = 256
SLICE = 10_000


def has_failed() -> Column:
    """A transport error or an HTTP status of 400 and above."""
    return F.col("error").isNotNull() | F.coalesce(F.col("status") >= 400, F.lit(False))


def failure_details() -> dict[str, Column]:
    """What went wrong with a failed response; all NULL for the others."""
    transport = F.col("error").isNotNull()
    answered = has_failed() & ~transport
    return {
        "error": F.when(transport, F.col("error")).when(
            answered, F.concat(F.lit("HTTP "), F.col("status").cast("string"))
        ),
        "failure_type": F.when(transport, F.col("failure_type")).when(answered, "http_status"),
        "http_status": F.when(answered, F.col("status")).cast("long"),
        "final_url": F.when(has_failed(), F.col("url")),
        "content_type": F.when(answered, F.nullif(F.col("content_type"), F.lit(""))),
    }


def failed_responses(documents: DataFrame) -> DataFrame:
    """The failures, with what went wrong; nothing else is read from such a response."""
    details = [value.alias(name) for name, value in failure_details().items()]
    return documents.where(has_failed()).select("seq", "request_url", *details)


def matching_pages(documents: DataFrame, url_filter: str | Sequence[str] | None) -> DataFrame:
    """Good responses whose URL any of the patterns finds."""
    return documents.where(~has_failed()).where(url_matches(F.col("url"), url_filter))


def response_predicate(response_filter: str | Column | None) -> Column:
    """The keep rule over a response document; textual content when none is given."""
    if response_filter is None or (isinstance(response_filter, str) and not response_filter):
        return is_textual(F.col("content_type"))
    rule = F.expr(response_filter) if isinstance(response_filter, str) else response_filter
    return F.coalesce(rule.cast("boolean"), F.lit(False))


def accepted_pages(pages: DataFrame, response_filter: str | Column | None = None) -> DataFrame:
    return pages.where(response_predicate(response_filter))


def limit_pages(pages: DataFrame, limit: int | None, order: str = "seq") -> DataFrame:
    """The first ``limit`` pages by ``order``, whose values are unique.

    Only order values are ranked; the pages themselves are filtered in place, so no task
    receives them all.
    """
    if limit is None:
        return pages
    last = nth_value(pages.select(F.col(order).cast("long").alias("value")), limit) if limit > 0 else None
    if last is None:
        return pages.where(F.lit(limit > 0))
    return pages.where(F.col(order) <= last)


def nth_value(values: DataFrame, n: int) -> int | None:
    """The ``n``-th smallest (from 1) of the longs in ``value``; None when there are fewer.

    Each round cuts the range that holds it at approximate quantiles and counts the values
    between the cuts, which are combined before the shuffle; the range then shrinks to one
    part.  So no task gets more than ``CUTS`` counts, or at last ``SLICE`` values, however
    the values are spread.
    """
    values = cut_lineage(values.where(F.col("value").isNotNull()))
    rank, count = n, values.count()
    if count < n:
        return None
    while count > SLICE:
        shares = [k / CUTS for k in range(1, CUTS)]
        cuts = values.select(F.percentile_approx("value", shares, 10 * CUTS).alias("cuts")).first()["cuts"]
        cuts = sorted(set(cuts))
        # A value belongs to the first cut that is not below it.
        bounds = F.array(*map(F.lit, cuts))
        place = F.size(F.filter(bounds, lambda cut: cut < F.col("value")))
        counts = values.groupBy(place.alias("part")).agg(
            F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        for row in sorted(counts.collect(), key=lambda row: row["part"]):
            if rank <= row["rows"]:
                break
            rank -= row["rows"]
        if row["low"] == row["high"]:
            return row["low"]
        values = values.where(F.col("value").between(row["low"], row["high"]))
        count = row["rows"]
    return values.orderBy("value").limit(rank).agg(F.max("value")).first()[0]
