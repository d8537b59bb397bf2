"""Mixing sources to target weights by weighted fair queueing.

Each source serves its documents in a shuffled order, round after round.  A copy of a
document finishes at virtual time ``words of its source so far / target of its source``, so
every source has served its target at time 1.  The targets add up to the total budget, so a sort
of the copies by that time over all sources, cut where the budget is spent, is cut at time 1 in
every source.  The cut is therefore made per source, at its rounded target, without that sort; the
copy in service then is taken in part.  Only the rows returned are sorted over all sources, by the
finish time of their first copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, boxed, cut_lineage, narrow_side

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
MAX_PASSES = 3
#: Documents of a source summed in one window, on average.
BLOCK_ROWS = 2_000


def ticket(id_column: Column, text: Column) -> Column:
    """Place of a document in the shuffled order of its source."""
    return F.md5(F.concat_ws(":", id_column, F.md5(F.coalesce(text, F.lit("")))))


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES
) -> DataFrame:
    """(``source``, ``source_size``, ``target``, ``weight``) from (``source``, ``source_size``).

    The budget is the sum of all sizes, shared by weight.  A target stops at ``max_passes``
    times its source's size.  Sources reach that stop in the order of ``source_size / weight``,
    so the share of the others follows from running sums in that order.  One row per source:
    the catalogue of sources is small, and only it is ordered as a whole.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, weights)),
            F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1,
        ).cast("long"),
    )
    by_ratio = Window.orderBy(
        (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * max_passes
    level = (
        ranked.withColumn("budget", F.sum("source_size").over(every))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("stopped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(after))
        .withColumn("level", (F.col("budget") - F.col("stopped")) / F.col("open_weight"))
        .withColumn("capped", cap <= F.col("level") * F.col("weight"))
    )
    # The sources that stop are a prefix of the order; the first that does not sets the level.
    open_level = F.min(F.when(~F.col("capped"), F.struct("place", "level")))
    shared = level.withColumn("share", open_level.over(every)["level"])
    return shared.select(
        "source",
        "source_size",
        F.when(F.col("capped"), cap.cast("double"))
        .otherwise(F.col("share") * F.col("weight"))
        .alias("target"),
        "weight",
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """What the mix takes of every document, in the order of its first virtual finish time.

    Returns ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``finish`` (virtual
    finish time of the first copy, null where the source has no target).  A null text has no
    words and is taken 0 times; a null source is a source of its own, the last; rows that
    repeat an id are rows of their own; an empty table gives an empty result; other columns
    are ignored.  The order is a hash of id and text, so reruns agree.
    """
    return _queue(docs, id_column, source_column, text_column, weights, max_passes).drop("ticket")


def _queue(docs, id_column, source_column, text_column, weights, max_passes) -> DataFrame:
    sized = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            word_count(F.col(text_column)).alias("size"),
            ticket(F.col(id_column), F.col(text_column)).alias("ticket"),
        )
    )
    counts = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    counts = cut_lineage(counts)
    targets = source_targets(counts.drop("rows"), weights, max_passes)
    plan = cut_lineage(
        targets.join(
            counts.select(F.col("source").alias("_source"), "rows"),
            F.col("source").eqNullSafe(F.col("_source")),
        ).select(
            F.col("source").alias("_source"), "source_size", "target",
            F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"),
        )
    )
    # A block is a range of tickets: the blocks in order are the shuffled order of the source.
    spot = F.conv(F.substring("ticket", 1, 8), 16, 10).cast("long")
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "block", F.floor(spot * F.col("blocks") / F.lit(float(1 << 32)))
    )
    keys = ["source", "block"]
    in_order = ["ticket", "doc_id", "size"]
    blocks = placed.groupBy(*keys).agg(F.sum("size").alias("block_size"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = blocks.select(
        F.col("source").alias("_s"), F.col("block").alias("_b"),
        F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy(*keys).orderBy(*in_order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    queued = (
        placed.withColumn("_upto", F.sum("size").over(inside))
        .join(blocks, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
        .withColumn("end", F.col("base") + F.col("_upto"))
    )
    quota = F.round(F.col("target")).cast("long")
    copies = [
        F.greatest(
            F.lit(0),
            F.least(F.col("size"), quota - (F.col("end") - F.col("size") + n * F.col("source_size"))),
        )
        for n in range(max_passes)
    ]
    taken = copies[0]
    for copy in copies[1:]:
        taken = taken + copy
    finish = F.when(F.col("target") > 0, F.col("end") / F.col("target"))
    return queued.select(
        "ticket", "doc_id", "size", "source_size", "target",
        taken.cast("long").alias("taken"), finish.alias("finish"),
    ).orderBy(F.col("finish").asc_nulls_last(), "doc_id")


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """``docs`` as the mix takes them: a row for each copy, none for those left out.

    The copy in which the budget ends stays whole if half of it or more is taken.
    """
    mixed = _queue(docs, id_column, source_column, text_column, weights, max_passes)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
    # Rows equal in id and text share a ticket; one of them stands for all their copies.
    chosen = cut_lineage(
        mixed.groupBy("ticket")
        .agg(F.sum(times).cast("int").alias("times"), F.count("*").alias("rows"))
        .where("times > 0")
    )
    own = ticket(F.col("doc")[id_column], F.col("doc")[text_column])
    joined = boxed(docs).withColumn("own", own)
    joined = joined.join(narrow_side(chosen, 64), F.col("own") == F.col("ticket"))
    once = Window.partitionBy("own").orderBy(F.lit(1))
    repeated = joined.where("rows > 1").withColumn("n", F.row_number().over(once)).where("n = 1")
    return (
        joined.where("rows = 1")
        .unionByName(repeated.drop("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("doc.*")
    )
