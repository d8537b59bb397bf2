"""Shards of near equal bytes by Karmarkar-Karp differencing of indivisible groups.

Equal texts are one group.  Groups are dealt over blocks by their digest; in a block the two
partial partitions of largest spread are combined, one in falling and one in rising order of its
sums, until one is left.  The blocks' partitions are then combined in the same way, level by level,
so no task ever holds more than a block of groups or a thousand partitions.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import byte_size, cut_lineage

SHARDS = 24
#: Bytes that a row weighs beside its text.
ROW_BYTES = 8
#: Groups differenced in one task, on average.
BLOCK_GROUPS = 20_000
#: Partial partitions combined in one task.
FAN_IN = 1_000
#: A group with at least this share of the rows is broadcast: at most ``1 / HOT_SHARE`` are.
HOT_SHARE = 1e-3


def difference(parts: list[tuple[list[int], list]]) -> tuple[list[int], list]:
    """Combine partial partitions (sums, members per sum), always the two of largest spread."""
    heap = []
    for number, (sums, members) in enumerate(parts):
        order = sorted(range(len(sums)), key=lambda i: -sums[i])
        own = [sums[i] for i in order]
        heap.append((own[-1] - own[0], number, own, [members[i] for i in order]))
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heapq.heappop(heap)
        both = [x + y for x, y in zip(a, reversed(b))]
        pairs = zip(of_a, reversed(of_b))
        joined = [None if x is None and y is None else (x, y) for x, y in pairs]
        order = sorted(range(len(both)), key=both.__getitem__, reverse=True)
        own = [both[i] for i in order]
        heapq.heappush(heap, (own[-1] - own[0], number, own, [joined[i] for i in order]))
        number += 1
    return heap[0][2], heap[0][3]


def _leaves(tree):
    stack = [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        elif node is not None:
            yield node


def _first_level(shards: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "digest"], ascending=[False, True]).reset_index(drop=True)
        empty = [0] * (shards - 1)
        parts = [([size, *empty], [i, *[None] * (shards - 1)]) for i, size in enumerate(pdf["bytes"].tolist())]
        sums, members = difference(parts)
        slot = [0] * len(pdf)
        for s, tree in enumerate(members):
            for i in _leaves(tree):
                slot[i] = s
        return pdf[["digest", "bytes", "block"]].assign(slot=slot)

    return run


def _next_level(shards: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        parts = [
            (list(map(int, sums)), [(i, s) for s in range(shards)]) for i, sums in enumerate(pdf["sums"])
        ]
        # Members are (row, slot); they are boxed so that a pair is not taken for a tree.
        boxed = [(sums, [[member] for member in members]) for sums, members in parts]
        sums, trees = difference(boxed)
        target = [[0] * shards for _ in range(len(pdf))]
        for s, tree in enumerate(trees):
            for leaf in _leaves(tree):
                i, old = leaf[0]
                target[i][old] = s
        return pdf[["node"]].assign(parent=int(key[0]), target=target, total=[sums] * len(pdf))

    return run


def _combined(sums: DataFrame, shards: int) -> DataFrame:
    """(``block``, ``shard_of``: the shard of each of the block's slots)."""
    mapping = sums.select("node", F.col("node").alias("top"), F.sequence(F.lit(0), F.lit(shards - 1)).alias("shard_of"))
    nodes = sums.count()
    while nodes > 1:
        parents = -(-nodes // FAN_IN)
        level = cut_lineage(
            sums.withColumn("_parent", F.col("node") % parents)
            .groupBy("_parent")
            .applyInPandas(_next_level(shards), "node long, parent long, target array<int>, total array<long>")
        )
        step = level.select(F.col("node").alias("_node"), "parent", "target")
        mapping = cut_lineage(
            mapping.join(step, F.col("top") == F.col("_node")).select(
                "node",
                F.col("parent").alias("top"),
                F.transform("shard_of", lambda s: F.get("target", s)).alias("shard_of"),
            )
        )
        sums = cut_lineage(
            level.groupBy(F.col("parent").alias("node")).agg(F.first("total").alias("sums"))
        )
        nodes = parents
    return mapping.select(F.col("node").alias("block"), "shard_of")


def shard_by_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS
) -> DataFrame:
    """A shard and a place in it for every document, equal texts together.

    Returns ``doc_id``, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` and
    ``grown_shard`` (null).  A null text has no bytes and is the empty text; rows that repeat an
    id are rows of their own; an empty table gives an empty result; other columns are ignored.
    A group larger than a shard's share has a shard nearly to itself.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (byte_size(F.col(text_column)) + ROW_BYTES).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = cut_lineage(
        rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    )
    total, distinct = rows.count(), groups.count()
    blocks = max(1, -(-distinct // BLOCK_GROUPS))
    dealt = groups.select("digest", "bytes", F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block"))
    placed = cut_lineage(
        dealt.groupBy("block").applyInPandas(
            _first_level(shards), "digest binary, bytes long, block long, slot int"
        )
    )
    per_slot = placed.groupBy("block", "slot").agg(F.sum("bytes").alias("bytes"))
    filled = per_slot.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("slot", "bytes"))).alias("m"))
    sums = cut_lineage(
        filled.select(
            F.col("block").alias("node"),
            F.transform(
                F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at("m", s), F.lit(0))
            ).alias("sums"),
        )
    )
    mapping = _combined(sums, shards)
    located = placed.join(mapping, "block").select(
        "digest", F.get("shard_of", F.col("slot")).alias("shard")
    )
    located = cut_lineage(located.join(groups.select("digest", "rows"), "digest"))
    hot = located.where(F.col("rows") >= F.lit(max(2.0, total * HOT_SHARE)))
    near = rows.join(F.broadcast(hot.select("digest", F.col("shard").alias("hot"))), "digest", "left")
    ready = near.where("hot is not null").withColumnRenamed("hot", "shard")
    rest = near.where("hot is null").drop("hot").join(located.select("digest", "shard"), "digest")
    columns = ["doc_id", "size", "text_crc32", "shard", "row"]
    sharded = ready.select(*columns).unionByName(rest.select(*columns))
    return _numbered(sharded, total, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(sharded: DataFrame, total: int, shards: int) -> DataFrame:
    """``slot``: gapless numbers in each shard, found in stretches of bounded length."""
    stretches = max(1, -(-total // (BLOCK_GROUPS // 4 * shards)))
    cut = cut_lineage(
        sharded.withColumn("stretch", F.pmod(F.xxhash64("row"), F.lit(stretches)))
    )
    counts = cut.groupBy("shard", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col("shard").alias("_s"), F.col("stretch").alias("_t"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy("shard", "stretch").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    return (
        cut.withColumn("place", F.row_number().over(inside) - 1)
        .join(base, (F.col("shard") == F.col("_s")) & (F.col("stretch") == F.col("_t")))
        .withColumn("slot", (F.col("base") + F.col("place")).cast("long"))
    )
