"""Exact dedup by a heavy-hitter split.

Misra-Gries counters find the digests that hold a large share of the rows.  Their exact
winners, at most ``1 / support`` of them, are broadcast, so their rows never meet in one
task.  All other digests go through an ordinary aggregation and join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import boxed, cut_lineage, narrow_side

#: A digest with at least this share of the rows is found for certain; so at most
#: ``1 / SUPPORT`` digests are broadcast.
SUPPORT = 1e-3


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``id``, ``row``, ``digest``) of every row; a null text counts as empty.

    ``row`` tells rows with one id apart.  The table is checkpointed, as it is read several
    times and the row numbers must not change between them.
    """
    return cut_lineage(
        docs.select(
            F.col(id_column).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)).alias("digest"),
        )
    )


def frequent(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Misra-Gries candidates: at most ``1 / support`` digests, all the frequent ones among them."""
    found = rows.select(F.hex("digest").alias("digest")).stat.freqItems(["digest"], support)
    return found.select(F.explode("digest_freqItems").alias("digest")).select(
        F.unhex("digest").alias("digest")
    )


def winners(rows: DataFrame) -> DataFrame:
    """(``digest``, ``keep_id``, ``keep_row``, ``group_size``) of every digest.

    The largest id stays and null is the smallest; among rows with one id, the last ``row``.
    """
    best = F.max(F.struct("id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "digest",
        F.col("best.id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        "group_size",
    )


def resolve(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``rows`` with the winner of each row's digest, hot digests on the map side."""
    candidates = cut_lineage(frequent(rows, support))
    hot = cut_lineage(winners(rows.join(F.broadcast(candidates), "digest", "left_semi")))
    packed = hot.select("digest", F.struct("keep_id", "keep_row", "group_size").alias("hot"))
    tagged = rows.join(F.broadcast(packed), "digest", "left")
    ready = tagged.where(F.col("hot").isNotNull()).select(*rows.columns, "hot.*")
    cold = tagged.where(F.col("hot").isNull()).select(*rows.columns)
    return ready.unionByName(cold.join(winners(cold), "digest"))


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """Which row of each group of equal texts stays: one row per row of ``docs``.

    Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.  A null text
    is empty; a null id is the smallest; of rows that repeat an id, exactly one stays; an
    empty table gives an empty result; other columns are ignored.
    """
    rows = digests(docs, id_column, text_column)
    return resolve(rows, support).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """``docs`` without the rows that lose, one row for each text.

    Only ids and digests are compared across rows; texts move once, to meet the verdict on
    their row.  Rows equal in id and text are one row, whichever of their other columns stay.
    """
    verdict = exact_dedup(docs, id_column, text_column, support)
    copies = cut_lineage(
        verdict.where("group_size > 1")
        .groupBy(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("digest"))
        .agg(F.max("kept").alias("kept"), F.count("*").alias("times"))
    )
    own = F.unhex(F.sha2(F.coalesce(F.col("doc")[text_column], F.lit("")), 256))
    tagged = boxed(docs).withColumn("own", own)
    tagged = tagged.join(
        narrow_side(copies, 64),
        F.col("doc")[id_column].eqNullSafe(F.col("id")) & (F.col("own") == F.col("digest")),
        "left",
    )
    once = Window.partitionBy("id", "digest").orderBy(F.lit(1))
    repeated = tagged.where("kept and times > 1").withColumn("n", F.row_number().over(once))
    single = tagged.where("times is null or (kept and times = 1)").select("doc.*")
    return single.unionByName(repeated.where("n = 1").select("doc.*"))
