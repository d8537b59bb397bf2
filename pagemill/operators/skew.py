"""Joins whose many-side may hold a large share of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that take the broadcast route: at most this many, so their side is bounded.
HOT_KEYS = 1_000
#: Fewer rows than this under one key never need it.
HOT_ROWS = 100_000
_SALTS = 1_024


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    counts: DataFrame | None = None,
    how: str = "inner",
    hot_keys: int = HOT_KEYS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``many`` to the at most one row of ``one`` per key, whatever the skew.

    The ``hot_keys`` most frequent keys of ``many`` meet a broadcast of their rows of
    ``one``, which is at most ``hot_keys`` rows.  Any other key holds less than
    1/``hot_keys`` of the rows, so the shuffle join that serves those is even; hot rows
    pass through it under salted keys that match nothing.  Rows of ``many`` should differ
    from each other, since the salt is taken from their columns.  ``counts`` (``key``, ``rows``)
    saves counting when the caller has the counts already.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    payload = [name for name in one.columns if name != key]
    if counts is None:
        counts = many.groupBy(key).agg(F.count("*").alias("rows"))
    hot = (
        counts.where((F.col("rows") >= hot_rows) & F.col(key).isNotNull())
        .orderBy(F.desc("rows"), key)
        .limit(hot_keys)
        .select(key)
    )
    packed = F.struct(*payload) if payload else F.struct(F.lit(True).alias("found"))
    hot_side = hot.join(one.select(key, packed.alias("_hot")), key, "left").select(
        F.col(key).alias("_hot_key"), "_hot"
    )
    tagged = many.join(F.broadcast(hot_side), F.col(key) == F.col("_hot_key"), "left")
    # The salt is a function of the row, so a recomputed task sends it the same way.
    salt = F.concat(F.lit("\x00hot"), F.pmod(F.xxhash64(*many.columns), F.lit(_SALTS)).cast("string"))
    cold = F.col("_hot_key").isNull() & F.col(key).isNotNull()
    tagged = tagged.withColumn("_key", F.when(cold, F.col(key).cast("string")).otherwise(salt))
    cold_side = one.select(F.col(key).cast("string").alias("_key"), packed.alias("_cold"))
    joined = tagged.join(cold_side, "_key", "left").withColumn(
        "_found", F.coalesce("_hot", "_cold")
    )
    if how == "inner":
        joined = joined.where(F.col("_found").isNotNull())
    return joined.select(*many.columns, *(F.col("_found")[name].alias(name) for name in payload))
