"""Write batches bounded by rows and bytes, and rows at rest in files of a bounded length.

A writer takes the rows of a group in order, closes the open batch before a row that would take
it over the byte limit, and after the row that fills its row limit.  Where a batch starts depends
on all rows before it, so rows are ranged by group and order into parts of bounded length.  Only
the first group of a part may find a batch open: the part states what it would do for every way
that batch may enter, the short statements are followed in order, and every part then numbers its
own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.session import cut_lineage, drop_checkpoint

#: Rows of a part, on average.
PART_ROWS = 1 << 16
#: Files that a task writes, on average.
TASK_FILES = 500
#: What stands for bytes that are not known, or not bounded.
UNKNOWN, UNBOUNDED = -1, 1 << 62
#: The number, rows and bytes of the open batch.
State = tuple[int, int, int]


class _Rows:
    """Consecutive rows of groups in order, and where a batch that starts at each would end."""

    def __init__(self, columns: list[pa.RecordBatch], group: str, limit: int, octets: int):
        table = pa.Table.from_batches(columns)
        self.count, self.limit, self.octets = len(table), limit, octets
        self.groups = table[group].to_pylist()
        edges = [i for i in range(1, self.count) if self.groups[i] != self.groups[i - 1]]
        self.begins, self.ends = [0, *edges], [*edges, self.count]
        sizes = table["_size"].to_pylist()
        self.sums = np.cumsum([0, *(size or 0 for size in sizes)])
        # With a row of unknown size in it, a batch is closed by its rows alone.
        unknown = np.array([*(i for i, size in enumerate(sizes) if size is None), UNBOUNDED])
        starts = np.arange(self.count)
        self.unknown = unknown[np.searchsorted(unknown, np.arange(self.count + 1))]
        over = np.maximum(np.searchsorted(self.sums, self.sums[:-1] + octets, side="right") - 1, starts + 1)
        over[over >= self.unknown[:-1]] = UNBOUNDED
        over[over == self.count] = UNBOUNDED
        self.following = np.minimum(over, starts + limit)

    def taken(self, count: int, held: int) -> int:
        """Rows of the first group that an open batch of ``count`` rows, ``held`` bytes takes."""
        fits = UNBOUNDED
        if held != UNKNOWN:
            fits = max(0, int(np.searchsorted(self.sums, self.octets - held, side="right")) - 1)
        if fits >= self.unknown[0]:
            fits = UNBOUNDED
        return min(fits, self.limit - count, self.ends[0])

    def after(self, state: State, start: int, end: int) -> State:
        """The open batch after it took the rows from ``start`` to ``end``."""
        batch, count, held = state
        count += end - start
        if count >= self.limit:
            return batch + 1, 0, 0
        if held != UNKNOWN:
            held = UNKNOWN if self.unknown[start] < end else held + int(self.sums[end] - self.sums[start])
        return batch, count, held

    def cuts(self, start: int, end: int) -> list[int]:
        """Where batches begin in the rows of one group, the first at ``start``."""
        found, following = [], self.following[start:end].tolist()
        at = start
        while at < end:
            found.append(at)
            at = following[at - start]
        return found

    def number(self, state: State, goes_on: bool) -> tuple[np.ndarray, State]:
        """The batch of every row, and the open batch after the last."""
        numbers = np.empty(self.count, dtype=np.int64)
        for begin, end in zip(self.begins, self.ends):
            start = begin
            if begin or not goes_on:
                state = (0, 0, 0)
            elif state[1]:
                start = self.taken(state[1], state[2])
                numbers[:start] = state[0]
                state = self.after(state, 0, start)
                if start < end and state[1]:
                    state = (state[0] + 1, 0, 0)
            cuts = self.cuts(start, end)
            if cuts:
                lengths = np.diff([*cuts, end])
                numbers[start:end] = np.repeat(np.arange(len(cuts)) + state[0], lengths)
                state = self.after((state[0] + len(cuts) - 1, 0, 0), cuts[-1], end)
        return numbers, state

    def statement(self) -> dict:
        """What follows for the first group if its first new batch starts at row 0, 1, ..."""
        end = self.ends[0]
        following = self.following[:end].tolist()
        closed, last = [0] * (end + 1), [end] * (end + 1)
        for start in range(end - 1, -1, -1):
            after = following[start]
            if after < end:
                closed[start], last[start] = closed[after] + 1, last[after]
            else:
                last[start] = start
        outcomes = [
            self.after((closed[start], 0, 0), last[start], end) for start in range(min(end, self.limit) + 1)
        ]
        cuts = self.cuts(self.begins[-1], self.count)
        tail = self.after((len(cuts) - 1, 0, 0), cuts[-1], self.count)
        return {
            "first": self.groups[0], "last": self.groups[-1], "n_groups": len(self.begins), "n_rows": end,
            "fits": self.sums[: len(outcomes)].tolist(), "unknown": int(min(self.unknown[0], end)),
            "outcomes": [number for outcome in outcomes for number in outcome],
            "tail": list(tail),
        }


def _entries(statements: Iterator, limit: int, octets: int) -> Iterator[tuple[int, int, int, int]]:
    """(part, number, rows, bytes of the batch that is open) for each statement, in order."""
    before, state = None, (0, 0, 0)
    for s in statements:
        goes_on = before is not None and before == (s["first"],)
        state = state if goes_on else (0, 0, 0)
        yield s["part"], *state
        number, count, held = state
        before = (s["last"],)
        if s["n_groups"] > 1:
            state = tuple(s["tail"])
            continue
        start = 0
        if count:
            fits = UNBOUNDED if held == UNKNOWN else max(0, sum(total + held <= octets for total in s["fits"]) - 1)
            if s["unknown"] < s["n_rows"] and fits >= s["unknown"]:
                fits = UNBOUNDED
            start = min(fits, limit - count, s["n_rows"])
            count += start
            if start == s["n_rows"] and count < limit:
                known = held != UNKNOWN and s["unknown"] >= start
                state = (number, count, held + s["fits"][start] if known else UNKNOWN)
                continue
            number += 1
        new, count, held = s["outcomes"][3 * start : 3 * start + 3]
        state = (number + new, count, held)


def number_batches(
    df: DataFrame,
    group: str,
    order: str = "seq",
    size: str | None = "record_bytes",
    batch_size: int = 100,
    max_batch_bytes: int | None = 16 * 1024 * 1024,
    part_rows: int = PART_ROWS,
    name: str = "batch",
) -> DataFrame:
    """``df`` and a long column ``name``: batches numbered from 0 in each group, in ``order``.

    Rows of a null group are a group, a null ``order`` comes last, and rows of equal order go by
    ``size``.  A row of null ``size`` leaves the bytes of its batch unknown, so that only the
    number of rows closes it.  Without ``max_batch_bytes`` no ``size`` is needed.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be greater than zero")
    if max_batch_bytes is not None and max_batch_bytes <= 0:
        raise ValueError("max_batch_bytes must be greater than zero or None")
    octets = UNBOUNDED if max_batch_bytes is None else int(max_batch_bytes)
    sized = df.withColumn("_size", F.lit(0).cast("long") if max_batch_bytes is None else F.col(size).cast("long"))
    stored = cut_lineage(sized)
    parts = max(1, -(-stored.count() // part_rows))
    keys = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_last(), F.col("_size").asc_nulls_last()]
    ranged = cut_lineage(stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
    drop_checkpoint(stored)
    kind, kept = df.schema[group].dataType, df.columns

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            stated = _Rows(held, group, batch_size, octets).statement()
            row = {"part": TaskContext.get().partitionId(), **stated}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    numbers = T.ArrayType(T.LongType())
    fields = [("part", T.LongType()), ("first", kind), ("last", kind), ("n_groups", T.LongType())]
    fields += [("n_rows", T.LongType()), ("fits", numbers), ("unknown", T.LongType())]
    fields += [("outcomes", numbers), ("tail", numbers)]
    schema = T.StructType([T.StructField(*field) for field in fields])
    arrow = to_arrow_schema(schema)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statements = (row for batch in batches for row in batch.to_pylist())
        for entry in _entries(statements, batch_size, octets):
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in entry], names=["part", *"abc"])

    # One short statement a part; their entries are three numbers a part.
    entries = {
        row.part: (row.a, row.b, row.c)
        for row in ranged.select(group, "_size").mapInArrow(describe, schema)
        .repartition(1).sortWithinPartitions("part")
        .mapInArrow(follow, "part long, a long, b long, c long").collect()
    }

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, before = entries.get(TaskContext.get().partitionId()), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows([batch.select([group, "_size"])], group, batch_size, octets)
            # The entry of a part is of its first group.
            marks, state = rows.number(state, before is None or before == (rows.groups[0],))
            before = (rows.groups[-1],)
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(marks)], names=[*kept, name])

    return ranged.mapInArrow(number, T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def write_batches(df: DataFrame, path: str, group: str, rows_per_file: int, order: str = "seq") -> None:
    """Write the rows under ``path``, a folder per value of ``group``, in files of bounded length.

    The files of a group follow each other by ``order``, and all but the last are full.  They are
    dealt over tasks by group and number, so that a task writes about ``TASK_FILES`` of them
    whatever the groups are like.
    """
    numbered = number_batches(df, group, order, None, rows_per_file, None, name="_file")
    sizes = numbered.groupBy(group).agg((F.max("_file") + 1).alias("files"))
    files = sizes.agg(F.sum("files").alias("files")).first().files or 0
    (
        numbered.repartition(max(1, -(-files // TASK_FILES)), group, "_file")
        .sortWithinPartitions(group, "_file", F.col(order).asc_nulls_last())
        .drop("_file")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "zstd")
        .partitionBy(group)
        .parquet(path)
    )


def batch_files(stored: DataFrame, group: str, *sums: str) -> DataFrame:
    """``<group>, rows, largest`` of what :func:`write_batches` wrote, and the ``sums``.

    ``largest`` is the number of rows in the longest file of the group.
    """
    by_file = stored.groupBy(group, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), *(F.sum(name).alias(name) for name in sums)
    )
    return by_file.groupBy(group).agg(
        F.sum("rows").alias("rows"), F.max("rows").alias("largest"), *(F.sum(name).alias(name) for name in sums)
    )
