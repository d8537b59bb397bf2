"""Last-wins dedupe, first occurrence and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The row with the highest ``order`` per key; ``order`` is unique within a key.

    The winners come from the two narrow columns alone, combined before the shuffle.  The
    full rows then meet them on (key, order), which spreads even a key that holds a large
    share of all rows.
    """
    winners = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(winners, [key, order], "left_semi")


def unique_first(df: DataFrame, value: str, order: str = "seq") -> DataFrame:
    """Each value once, with the lowest ``order`` it was seen at."""
    return df.groupBy(value).agg(F.min(order).alias(order))


def upsert(
    target: DataFrame, updates: DataFrame, key: str, order: str | None = None
) -> DataFrame:
    """Replace the matched rows and add the others; columns either side lacks are NULL.

    With ``order`` the updates are reduced to their last row per key first.
    """
    if order is not None:
        updates = keep_last(updates, key, order)
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True).select(
        *target.columns, *(name for name in updates.columns if name not in target.columns)
    )
