"""Best-fit packing of token sequences, bettered by swaps.

Documents are cut into pieces of at most one sequence; only numbers move on from there.  Pieces
are dealt over groups by a hash and each group is packed by itself: best fit over falling lengths,
then a local search among all bins that are not full moves a document or exchanges one for one,
one for two or two for one whenever that raises the sum of squared fills, until nothing helps.
Partners are found by size, so every pair of bins counts.  A group leaves at most a few bins short of full, so with thousands of bins a group the
loss against packing all at once is well below a thousandth.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import cut_lineage
from pagemill.llm.tokens import END_ID, each_text, encoder, tokenizer_path

CAPACITY = 2048
#: Documents packed together, on average.
GROUP_DOCS = 20_000
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, end_id: int):
    def cut(batches):
        encode = encoder(path).batch
        end = int(end_id).to_bytes(4, "little")
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(each_text(batch.column(1)))):
                raw = memoryview(ids + end)
                total, start, piece = len(raw) // 4, 0, 0
                length = total % capacity or capacity
                while start < total:
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    out.append((doc_id, row, piece, start, length, crc))
                    start, piece, length = start + length, piece + 1, capacity
                row += 1
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def token_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """(``doc_id``, ``row``, ``piece``, ``start``, ``length``, ``ids_crc32``) of every piece."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(_pieces(path or tokenizer_path(), capacity, end_id), PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``lengths``: each falls into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # sorted room sizes that some bin has
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[place]
        at = bisect_left(rooms, length)
        if at == len(rooms):
            bins.append([])
            number, room = len(bins) - 1, capacity
        else:
            room = rooms[at]
            number = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[number].append(place)
        room -= length
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(number)
    return bins


class _Sizes:
    """The open bins that hold each size, emptiest first; ``least`` has the smallest fill of each."""

    NONE = 1 << 40

    def __init__(self, capacity: int):
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.least = np.full(2 * capacity + 1, self.NONE, dtype=np.int64)

    def add(self, sizes, fill: int, number: int) -> None:
        for size in sizes:
            insort(self.bins[size], (fill, number))
            self.least[size] = self.bins[size][0][0]

    def drop(self, sizes, fill: int, number: int) -> None:
        for size in sizes:
            held = self.bins[size]
            held.pop(bisect_left(held, (fill, number)))
            self.least[size] = held[0][0] if held else self.NONE


def _sizes(lengths: list[int], items: list[int]) -> tuple[dict, dict]:
    """(size -> one item, size -> two items) of a bin; of equal sizes one stands for all."""
    equal: dict[int, list[int]] = {}
    for i in items:
        equal.setdefault(lengths[i], []).append(i)
    one = {size: (held[0],) for size, held in equal.items()}
    two = {2 * size: tuple(held[:2]) for size, held in equal.items() if len(held) > 1}
    distinct = list(equal)
    for k, size in enumerate(distinct):
        for other in distinct[:k]:
            two.setdefault(size + other, (equal[size][0], equal[other][0]))
    return one, two


def swap_search(lengths: list[int], bins: list[list[int]], capacity: int):
    """Better ``bins`` in place by moves and exchanges among those that are not full.

    In each step a bin gains by an item of another, by one against one or two of its own, or by two
    against one of its own, so that the sum of squared fills rises most.  The search ends when no
    such step is left between any two bins; it must end, as the sum is a bounded whole number.
    """
    fill = [sum(lengths[i] for i in items) for items in bins]
    ones, twos = _Sizes(capacity), _Sizes(capacity)
    own: dict[int, tuple[dict, dict]] = {}  # of the bins that are open

    def enter(b):
        if bins[b] and fill[b] < capacity:
            own[b] = _sizes(lengths, bins[b])
            ones.add(own[b][0], fill[b], b)
            twos.add(own[b][1], fill[b], b)

    def leave(b):
        ones.drop(own[b][0], fill[b], b)
        twos.drop(own[b][1], fill[b], b)
        return own.pop(b)

    for b in range(len(bins)):
        enter(b)
    changed = True
    while changed:
        changed = False
        for taker in sorted(own, key=lambda b: -fill[b]):
            while taker in own:
                mine = leave(taker)
                step = _step(ones, twos, mine, fill[taker], capacity)
                if step is None:
                    enter(taker)
                    break
                giver, count, size, back = step
                given = leave(giver)[count - 1][size]
                for i in given:
                    bins[giver].remove(i)
                for i in back:
                    bins[taker].remove(i)
                bins[taker] += given
                bins[giver] += back
                gain = size - sum(lengths[i] for i in back)
                fill[taker] += gain
                fill[giver] -= gain
                enter(taker)
                enter(giver)
                changed = True
    return [b for b in bins if b]


def _step(ones: _Sizes, twos: _Sizes, mine: tuple[dict, dict], fill: int, capacity: int):
    """(giver, items given, their size, items given back) of the best step of a bin, or None.

    Of the bins that hold a size the emptiest gives, as that raises the sum of squares most.
    """
    one, two = mine
    gains = np.arange(1, capacity - fill + 1)
    best, chosen = 0, None
    for index, count, backs in ((ones, 1, [(0, ()), *one.items(), *two.items()]), (twos, 2, list(one.items()))):
        wanted = np.array([size for size, _ in backs])[:, None] + gains
        rise = gains * (fill + gains - index.least[wanted])
        at = int(rise.argmax())
        if rise.flat[at] > best:
            best = int(rise.flat[at])
            size = int(wanted.flat[at])
            chosen = (index.bins[size][0][1], count, size, backs[at // len(gains)][1])
    return chosen


def _pack_group(capacity: int):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        lengths = pdf["length"].tolist()
        bins = swap_search(lengths, best_fit(lengths, capacity), capacity)
        number, offset = [0] * len(lengths), [0] * len(lengths)
        for b, items in enumerate(bins):
            at = 0
            for i in items:
                number[i], offset[i] = b, at
                at += lengths[i]
        group = int(key[0])
        return pdf.drop(columns=["group"]).assign(
            sequence_id=[(group << 32) + b for b in number], offset=offset
        )

    return pack


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """Every piece of every document with its place in a sequence.

    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset``.  A null or empty text is its end id alone; rows that repeat an id are pieces of
    their own; an empty table gives an empty result; other columns are ignored; ids are longs.
    """
    pieces = cut_lineage(token_pieces(docs, id_column, text_column, path, capacity, end_id))
    documents = pieces.where("piece = 0").count()
    groups = max(1, -(-documents // group_docs))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "ids_crc32"), F.lit(groups)))
    partial = dealt.where(F.col("length") < capacity)
    schema = PIECES + ", sequence_id long, offset long"
    packed = partial.groupBy("group").applyInPandas(_pack_group(capacity), schema)
    # A full piece is a sequence by itself: its number is negative and unique.
    full = dealt.where(F.col("length") == capacity).select(
        *pieces.columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full).drop("row")
