"""Helpers of the training-data operators: tables, word hashes, bounded memos."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import cut_lineage, shared_dir

#: A word is a run of bytes outside space, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def byte_size(text: str | Column) -> Column:
    """UTF-8 bytes; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def boxed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``doc``, so that no helper column clashes with its own."""
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("doc"))


def narrow_side(side: DataFrame, row_bytes: int) -> DataFrame:
    """``side`` with a broadcast hint if its counted rows fit ``BROADCAST_BYTES``.

    ``side`` should be a checkpointed table, as it is counted here.  Beyond the bound the
    hint is left out and the join shuffles, with the same result.
    """
    if side.count() * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(side)
    return side


def settled(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` checkpointed, in partitions of at least about ``rows`` rows.

    Loops over tables that shrink would otherwise write a file per task and shuffle for a
    handful of rows each.
    """
    df = cut_lineage(df)
    return df.coalesce(max(1, -(-df.count() // rows)))


class Memo(dict):
    """``compute`` with memory of at most twice ``limit`` recent keys.

    When the young half is full it becomes the old half; a key found there moves back, so
    frequent keys stay and memory is bounded whatever the input holds.
    """

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self._compute, self._limit, self._old = compute, limit, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


# --- counters of a fixed size, summed over all tasks -----------------------------------

COUNTER_CHUNKS = 16


def counter_chunks(counters: np.ndarray) -> list[bytes]:
    """A task's counters, cut so that the sum is spread over tasks."""
    return [zlib.compress(part.tobytes(), 1) for part in np.array_split(counters, COUNTER_CHUNKS)]


def _add_counters(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(raw), dtype=np.int64) for raw in pdf["counters"])
    return pdf.iloc[:1][["chunk"]].assign(counters=[total.tobytes()])


def summed_counters(chunks: DataFrame) -> np.ndarray:
    """The sum of all tasks' (``chunk``, ``counters``): as large as one task's, whatever the input."""
    parts = chunks.groupBy("chunk").applyInPandas(_add_counters, "chunk int, counters binary")
    rows = sorted(parts.collect(), key=lambda row: row.chunk)
    return np.concatenate([np.frombuffer(row.counters, dtype=np.int64) for row in rows])


# --- word and shingle hashes -----------------------------------------------------------

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time, so that a long text needs little memory besides itself.
_WINDOW = 1 << 19


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    values = (values ^ (values >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U64(27))) * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


def _weights(seed: int, count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=_U64) * _U64(0xD1342543DE82EF95) + _U64(seed))


_EXACT = _weights(1, 256)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ORDER = _weights(2, 16) | _U64(1)
_powers = np.zeros(0, dtype=_U64)
_inverses = np.zeros(0, dtype=_U64)


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < length:
        with np.errstate(over="ignore"):
            steps = np.full(length, _BASE, dtype=_U64)
            back = np.full(length, _INVERSE, dtype=_U64)
            steps[0] = back[0] = 1
            _powers, _inverses = np.cumprod(steps), np.cumprod(back)
    return _powers, _inverses


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(text: bytes, fold: bool = False) -> np.ndarray:
    """One 64-bit hash per word, in order; ``fold`` lower-cases A-Z first.

    A byte sequence hashes to the sum of its bytes' random weights times powers of an odd
    base, which prefix sums give for all words at once.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, dtype=_U64)
    table, parts, first = _FOLDED if fold else _EXACT, [], 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + _WINDOW, side="right")))
        piece = data[origin : ends[last - 1]]
        powers, inverses = _power_tables(max(len(piece), min(_WINDOW, 1 << 15)))
        sums = np.zeros(len(piece) + 1, dtype=_U64)
        np.cumsum(table[piece] * powers[: len(piece)], out=sums[1:])
        begin, end = starts[first:last] - origin, ends[first:last] - origin
        parts.append(mix((sums[end] - sums[begin]) * inverses[begin]))
        first = last
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` (at most 16) consecutive words."""
    count = len(words) - width + 1
    if count < 1:
        return np.zeros(0, dtype=_U64)
    total = words[:count] * _ORDER[0]
    for k in range(1, width):
        total = total + words[k : k + count] * _ORDER[k]
    return mix(total)


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased ``width``-word shingles.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    words = word_hashes((text or "").encode(), fold=True)
    if not len(words):
        return words
    if len(words) < width:
        whole = (words * _ORDER[: len(words)]).sum(dtype=_U64) + _U64(len(words))
        return mix(np.array([whole], dtype=_U64))
    return distinct_sorted(window_hashes(words, width))


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one Python tuple at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in columns)
