"""Periodic runs of words by internal pattern matching.

The words of a text are named by 64-bit hashes.  Prefix doubling sorts the suffixes and gives,
for each power of two L, the suffix-array interval of every block of L words that starts at a
multiple of L / 2.  A wavelet tree over the suffix array answers range successor: the next
occurrence of a block, which is a candidate if it starts at most L words later.

Why that finds every run of period q with at least max(6, 4 q) words: take the power of two L
with q <= L < 2 q (4 for q < 4).  The run holds a block of L words and, q later, its copy, as
L / 2 - 1 + L + q <= 4 q.  No copy lies nearer: by Fine and Wilf it would give the run a smaller
period.  So the successor starts at distance q: two terms of the arithmetic progression of the
block's occurrences.  Every candidate is then extended both ways, by the same doubling tables, to
the longest stretch with its distance as period; that is its smallest one for the same reason.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.textbatch import hashed_words, text_windows

#: The shortest run, in words and in periods.
MIN_WORDS = 6
MIN_PERIODS = 4
_FIRST_BLOCK = 4

#: New order of the words of the document ``doc_id`` with ``n`` words, or None to leave them.
Reorder = Callable[[int | None, int], np.ndarray | None]


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The repetition that the contract plants in a tenth of the documents; a null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


class WaveletTree:
    """Range successor over an array of numbers below ``2 ** bits``, for many queries at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self._levels = []
        for bit in reversed(range(bits)):
            ones = (values >> bit) & 1
            zeros_before = np.concatenate(([0], np.cumsum(1 - ones)))
            self._levels.append((bit, zeros_before, int(zeros_before[-1])))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of ``values[lo:hi]`` are below ``bound``."""
        count = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros, total in self._levels:
            one = ((bound >> bit) & 1).astype(bool)
            left, right = zeros[lo], zeros[hi]
            count += np.where(one, right - left, 0)
            lo = np.where(one, total + lo - left, left)
            hi = np.where(one, total + hi - right, right)
        return count

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest, from 0, of ``values[lo:hi]``; ``k`` is below ``hi - lo``."""
        value = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros, total in self._levels:
            left, right = zeros[lo], zeros[hi]
            one = k >= right - left
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - (right - left), k)
            lo = np.where(one, total + lo - left, left)
            hi = np.where(one, total + hi - right, right)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The smallest of ``values[lo:hi]`` above ``after``, or -1."""
        k = self.below(lo, hi, after + 1)
        some = k < hi - lo
        found = np.full(len(lo), -1, dtype=np.int64)
        found[some] = self.kth(lo[some], hi[some], k[some])
        return found


def _doubled(ranks: np.ndarray, ends: np.ndarray):
    """Yields (L, rank, size) for L = 1, 2, 4, ...: of each position, the number of suffixes with
    a smaller block of L words, and how many have the same one; at last the suffix array itself.

    ``ranks`` are dense names of words that no two texts share, so no block spans two texts:
    a suffix that ends before its block does has a block of its own.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], np.diff(ranks[order]) != 0)))
    lengths = np.diff(np.append(heads, n))
    rank, size = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    rank[order], size[order] = np.repeat(heads, lengths), np.repeat(lengths, lengths)
    length = 1
    yield length, rank, size
    while True:
        slots = np.flatnonzero(size[order] > 1)
        if not len(slots):
            break
        active = order[slots]
        behind = active + length
        key = np.where(behind < ends[active], rank[np.minimum(behind, n - 1)] + 1, 0)
        key += rank[active] * (n + 1)
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        lengths = np.diff(np.append(heads, len(key)))
        order[slots] = active
        rank, size = rank.copy(), size.copy()
        rank[active], size[active] = np.repeat(slots[heads], lengths), np.repeat(lengths, lengths)
        length *= 2
        yield length, rank, size
    yield 0, order, order


def word_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are hashes, text ``i`` has ``words[offsets[i] : offsets[i + 1]]``; starts count from
    the text's first word.
    """
    n = len(words)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return none, none, none, none
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    begins, ends = offsets[text], offsets[text + 1]
    # Names by (text, word): sorted, texts one after another, equal words of a text together.
    by = np.lexsort((words, text))
    fresh = np.concatenate(([True], (words[by][1:] != words[by][:-1]) | (text[by][1:] != text[by][:-1])))
    names = np.empty(n, dtype=np.int64)
    names[by] = np.cumsum(fresh) - 1
    tables, blocks = [], []
    for length, rank, size in _doubled(names, ends):
        if not length:
            order = rank
            break
        tables.append((length, rank))
        if length >= _FIRST_BLOCK:
            starts = np.arange(0, n, length // 2)
            starts = starts[(size[starts] > 1) & (starts + length <= ends[starts])]
            blocks.append((starts, np.full(len(starts), length), rank[starts], rank[starts] + size[starts]))
    if not blocks:
        return none, none, none, none
    starts, lengths, lo, hi = (np.concatenate(part) for part in zip(*blocks))
    if not len(starts):
        return none, none, none, none
    # Only slots of the suffix array inside some first-level interval are asked about.
    used = np.zeros(n + 1, dtype=np.int64)
    np.add.at(used, lo, 1)
    np.add.at(used, hi, -1)
    used = np.cumsum(used)[:n] > 0
    slot = np.concatenate(([0], np.cumsum(used)))
    places = (order - begins[order])[used]
    # One bit more than the places need, as ``after + 1`` is asked about.
    tree = WaveletTree(places, (int(places.max()) + 1).bit_length())
    local = starts - begins[starts]
    after = tree.successor(slot[lo], slot[hi], local)
    near = (after >= 0) & (after - local <= lengths)
    period, begin = (after - local)[near], starts[near]
    # The longest common extension of (begin, begin + period) both ways, by descending powers.
    left, right = begin.copy(), begin + period
    for length, rank in reversed(tables):
        fits = right + length <= ends[begin]
        fits[fits] = rank[right[fits]] == rank[(right - period)[fits]]
        right += np.where(fits, length, 0)
        fits = left - length >= begins[begin]
        fits[fits] = rank[(left - length)[fits]] == rank[(left + period - length)[fits]]
        left -= np.where(fits, length, 0)
    size = right - left
    long = size >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
    found = np.unique(np.stack([left[long], period[long], size[long]], axis=1), axis=0)
    left, period, size = found.T
    return text[left], left - begins[left], size, period


def _dropped(n: int, start: np.ndarray, size: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a run behind its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + size, -1)
    return np.cumsum(cover)[:n] > 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(reorder: Reorder | None):
    def window(ids, offsets, data):
        starts, words = hashed_words(data)
        bounds = np.searchsorted(starts, offsets)
        orders = {}
        if reorder is not None:
            for i, doc_id in enumerate(ids):
                order = reorder(doc_id, int(bounds[i + 1] - bounds[i]))
                if order is not None:
                    orders[i] = order
                    words[bounds[i] : bounds[i + 1]] = words[bounds[i] + order]
        text, start, size, period = word_runs(words, bounds)
        edges = np.searchsorted(text, np.arange(len(ids) + 1))
        rests = []
        for i in range(len(ids)):
            pieces = data[offsets[i] : offsets[i + 1]].tobytes().split()
            if i in orders:
                pieces = [pieces[k] for k in orders[i].tolist()]
            if edges[i] < edges[i + 1]:
                own = slice(edges[i], edges[i + 1])
                gone = _dropped(len(pieces), start[own], size[own], period[own])
                pieces = [pieces[k] for k in np.flatnonzero(~gone).tolist()]
            rests.append(b" ".join(pieces))
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(size), pa.array(period)], fields=list(_RUNS.value_type))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(np.diff(bounds)),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs),
                pa.array(rests, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, offsets, data in text_windows(batch.column(1)):
                yield window(ids[first : first + len(offsets) - 1], offsets, data)

    return run


def collapse_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reorder: Reorder | None = None
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period) and the ``collapsed`` text of every row.

    A run is a stretch of words with smallest period q, of at least max(6, 4 q) words, that no
    neighbouring word extends; of each run only the first period stays in ``collapsed``, whose
    words one space parts.  Runs come by start, then period.

    Null and empty texts, and those of white space only, have no words, no runs and an empty
    collapsed text.  Rows that repeat an id or a text are each worked on; ids are longs and may
    be null; an empty table gives an empty result; other columns are ignored.  A very long text
    is worked on whole, in memory of a few hundred bytes a word.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = (
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return rows.mapInArrow(_collapsed(reorder), schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """The contract's columns of documents with planted repetitions."""
    found = collapse_runs(docs, reorder=planted_order)
    # Structs order by length, then by the least start and period.
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("low"))
        )
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.low")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * best.length) div (-best.low)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
