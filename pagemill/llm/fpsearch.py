"""Ranked lexical search by branch and bound over FP-trees of documents.

A first pass counts terms and restricts each document to the items' terms.  A second pass orders
those vectors by the terms' document frequency, the most frequent first, and builds an FP-tree of
each chunk: documents with equal leading terms share a path.  Paths without branches are folded,
and runs of small neighbouring subtrees end in a bucket.  A node knows, of its subtree, the
largest tf of every term and the least m.  The score rises with tf and falls with m, so both give
an upper bound for any item.  Per item the tree is searched depth first, the most promising child
first; a subtree whose bound is below the item's worst kept score is left out.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import counter_chunks, cut_lineage, summed_counters
from pagemill.llm.textbatch import IN_TERM, Lookup, hashed_words, ranges, text_windows

TOP = 10
#: Documents of a tree, and of a bucket at the end of a path.
TREE_DOCS = 16_384
BUCKET = 64
#: UTF-8 bytes of items that are searched for at a time; more are worked on group by group.
ITEM_BYTES = 8 << 20
#: Partial results of an item are ranked in so many parts before they meet.
PARTS = 64
_NO_ID = np.iinfo(np.int64).max


# --- first pass: statistics and restricted vectors --------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(a.astype("<i8").tobytes() if a.dtype == np.int64 else a.tobytes() for a in arrays), 1)


def _block(ids, sizes, which, term, times) -> bytes:
    """Vectors of a window: counts, then ids, lengths, entries per document, terms and tfs."""
    head = np.array([len(ids), len(term)], dtype=np.int64)
    per_doc = np.bincount(which, minlength=len(ids)).astype(np.int64)
    return _packed(head, ids, sizes, per_doc, term.astype("<u4"), times.astype("<u4"))


def _unpacked(raw: bytes) -> tuple[np.ndarray, ...]:
    data = zlib.decompress(raw)
    docs, entries = (int(x) for x in np.frombuffer(data, "<i8", 2))
    ids, sizes, per_doc = np.frombuffer(data, "<i8", 3 * docs, 16).reshape(3, docs)
    term, times = np.frombuffer(data, "<u4", 2 * entries, 16 + 24 * docs).reshape(2, entries)
    return ids, sizes, per_doc, term.astype(np.int64), times.astype(np.int64)


def _restricted(vocabulary: np.ndarray):
    def run(batches):
        table = Lookup(vocabulary)
        counters = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            raw_ids = batch.column(0)
            all_ids = raw_ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            for first, offsets, data in text_windows(batch.column(1)):
                starts, hashes = hashed_words(data, IN_TERM, fold=True)
                sizes = np.diff(np.searchsorted(starts, offsets))
                counters[0] += np.count_nonzero(sizes)
                counters[1] += sizes.sum()
                at, term = table.find(hashes)
                if not len(at):
                    continue
                doc = np.searchsorted(offsets, starts[at], side="right") - 1
                keys, times = np.unique(doc * len(vocabulary) + term, return_counts=True)
                doc, term = np.divmod(keys, len(vocabulary))
                counters[2:] += np.bincount(term, minlength=len(vocabulary))
                some, doc = np.unique(doc, return_inverse=True)
                block = _block(all_ids[first : first + len(sizes)][some], sizes[some], doc, term, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None], pa.int32()), pa.array([block], pa.binary())], names=["chunk", "counters"]
                )
        parts = counter_chunks(counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "counters"]
        )

    return run


# --- second pass: trees and search ------------------------------------------------------


class Tree:
    """The FP-tree of one chunk of documents.

    ``ids`` and ``m`` per document; ``doc``, ``rank`` and ``tf`` per entry, where a smaller rank
    is a term of more documents.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, rank: np.ndarray, tf: np.ndarray):
        self.columns, column = np.unique(rank, return_inverse=True)
        by = np.lexsort((column, doc))
        doc, column, tf = doc[by], column[by], tf[by]
        count = np.bincount(doc, minlength=len(ids))
        start = np.cumsum(count) - count
        # Paths in order: big-endian bytes compare as the sequences of terms do.
        raw = column.astype(">u4").tobytes()
        paths = [raw[4 * s : 4 * (s + c)] for s, c in zip(start.tolist(), count.tolist())]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), dtype=np.int64)
        self.ids, self.m = ids[order], m[order]
        entries = ranges(start[order], count[order])
        column, tf, count = column[entries], tf[entries], count[order]
        start = np.cumsum(count) - count
        self._buckets, self._children = [], []
        shape = self._grown(_shared(column, start, count))
        self._summed(shape, column, tf, count)
        # Postings by term and place, to read a bucket.
        place = np.repeat(np.arange(len(ids)), count)
        by = np.lexsort((place, column))
        self._postings = column[by] * len(ids) + place[by]
        self._place, self._tf = place[by], tf[by]

    def _grown(self, shared: np.ndarray) -> list[tuple[int, int]]:
        """Document ranges of the nodes; children come after their parent."""
        spans, todo = [(0, len(self.ids))], [0]
        self._children = [[]]

        def add(parent, first, last):
            self._children[parent].append(len(spans))
            spans.append((first, last))
            self._children.append([])
            return len(spans) - 1

        while todo:
            node = todo.pop()
            first, last = spans[node]
            if last - first <= BUCKET:
                continue
            inner = shared[first + 1 : last]
            # The path is shared up to its least common prefix, where it branches.
            cuts = first + 1 + np.flatnonzero(inner == inner.min())
            edges = [first, *cuts.tolist(), last]
            begin = first
            for left, right in zip(edges, edges[1:]):
                if right - left > BUCKET:
                    if begin < left:
                        add(node, begin, left)
                    todo.append(add(node, left, right))
                    begin = right
                elif right - begin > BUCKET:
                    add(node, begin, left)
                    begin = left
            if begin < last:
                add(node, begin, last)
        return spans

    def _summed(self, spans, column, tf, count) -> None:
        """Per node the largest tf of each term and the least m."""
        self._spans = spans
        leaf = np.array([not below for below in self._children])
        leaves = np.flatnonzero(leaf)
        leaves = leaves[np.argsort(np.array(spans)[leaves, 0])]
        sizes = np.array([spans[k][1] - spans[k][0] for k in leaves.tolist()])
        owner = np.repeat(leaves, sizes)
        width = len(self.columns)
        flat = np.zeros(len(spans) * width, dtype=np.int64)
        np.maximum.at(flat, np.repeat(owner, count) * width + column, tf)
        self.most = flat.reshape(len(spans), width)
        self.least = np.full(len(spans), _NO_ID)
        np.minimum.at(self.least, owner, self.m)
        for node in range(len(spans) - 1, -1, -1):
            below = self._children[node]
            if below:
                self.most[node] = self.most[below].max(axis=0)
                self.least[node] = self.least[below].min()

    def search(self, rank: np.ndarray, weight: np.ndarray, found: Best) -> None:
        """Offers every document to ``found`` that the bounds do not exclude."""
        at = np.searchsorted(self.columns, rank)
        at[at == len(self.columns)] = 0
        here = self.columns[at] == rank
        column, weight = at[here], weight[here]
        if not len(column):
            return
        tf = self.most[:, column]
        bounds = (weight * _share(tf, self.least[:, None])).sum(axis=1)
        todo = [0]
        while todo:
            node = todo.pop()
            if bounds[node] < found.worst:
                continue
            below = self._children[node]
            if below:
                todo += sorted(below, key=bounds.__getitem__)
            else:
                self._offer(*self._spans[node], column, weight, found)

    def _offer(self, first: int, last: int, column, weight, found: Best) -> None:
        size = len(self.ids)
        lo = np.searchsorted(self._postings, column * size + first)
        count = np.searchsorted(self._postings, column * size + last) - lo
        entries = ranges(lo, count)
        place = self._place[entries]
        gain = np.repeat(weight, count) * _share(self._tf[entries], self.m[place])
        scores = np.zeros(last - first, dtype=np.int64)
        np.add.at(scores, place - first, gain)
        found.offer(scores, self.ids[first:last])


def _share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _shared(column: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of each path but the first, how many leading terms it shares with the one before."""
    shared = np.zeros(len(count), dtype=np.int64)
    both = np.minimum(count[1:], count[:-1])
    step = ranges(np.zeros(len(both), dtype=np.int64), both)
    differ = column[np.repeat(start[1:], both) + step] != column[np.repeat(start[:-1], both) + step]
    shared[1:] = both
    pair = np.repeat(np.arange(1, len(count)), both)
    np.minimum.at(shared, pair[differ], step[differ])
    return shared


class Best:
    """The highest scores met, equal ones by ascending id, null ids last; scores are above 0."""

    def __init__(self, top: int):
        self._top = top
        self.scores = self.ids = np.zeros(0, dtype=np.int64)
        #: A score below this cannot enter.
        self.worst = 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.worst)
        if not len(good):
            return
        scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
        by = np.lexsort((ids, -scores))[: self._top]
        self.scores, self.ids = scores[by], ids[by]
        if len(by) == self._top:
            self.worst = int(self.scores[-1])


def _searched(items: list[tuple], rank_of: np.ndarray, weights: np.ndarray, texts: int, terms: int, top: int):
    """``items``: (item id, term numbers); ``rank_of`` and ``weights`` per term number."""

    def tree(blocks) -> Tree:
        ids, sizes, per_doc, term, tf = (np.concatenate(part) for part in zip(*blocks))
        # Python's integers, as 90 * n * N may pass 64 bits.
        m = np.array([10 + 90 * n * texts // terms for n in sizes.tolist()], dtype=np.int64)
        return Tree(ids, m, np.repeat(np.arange(len(ids)), per_doc), rank_of[term], tf)

    def run(batches):
        best = [Best(top) for _ in items]
        blocks, docs = [], 0

        def search():
            grown = tree(blocks)
            for (_, numbers), found in zip(items, best):
                grown.search(rank_of[numbers], weights[numbers], found)

        for batch in batches:
            for raw in batch.column(0):
                block = _unpacked(raw.as_py())
                # Whole windows, unless one alone has more documents than a tree.
                for first in range(0, len(block[0]), TREE_DOCS):
                    part = _part(block, first, first + TREE_DOCS)
                    if docs + len(part[0]) > TREE_DOCS:
                        search()
                        blocks, docs = [], 0
                    blocks.append(part)
                    docs += len(part[0])
        if blocks:
            search()
        rows = [
            (item, score, None if doc == _NO_ID else doc)
            for (item, _), found in zip(items, best)
            for score, doc in zip(found.scores.tolist(), found.ids.tolist())
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], pa.int64()) for k in range(3)], names=["item_id", "score", "doc_id"]
        )

    return run


def _part(block, first: int, last: int):
    ids, sizes, per_doc, term, tf = block
    if first == 0 and last >= len(ids):
        return block
    begin, end = int(per_doc[:first].sum()), int(per_doc[:last].sum())
    return ids[first:last], sizes[first:last], per_doc[first:last], term[begin:end], tf[begin:end]


def _terms(text: str | None) -> np.ndarray:
    return np.unique(hashed_words(np.frombuffer((text or "").encode(), dtype=np.uint8), IN_TERM, fold=True)[1])


def _search_group(docs: DataFrame, items: list, top: int) -> DataFrame | None:
    """Ranks for a bounded group of (item id, text); None if it has no term."""
    by_item: dict[int | None, list[np.ndarray]] = {}
    for item, text in items:
        by_item.setdefault(item, []).append(_terms(text))
    terms = {item: np.unique(np.concatenate(parts)) for item, parts in by_item.items()}
    vocabulary = np.unique(np.concatenate(list(terms.values()))) if terms else np.zeros(0, np.uint64)
    if not len(vocabulary):
        return None
    passed = cut_lineage(docs.mapInArrow(_restricted(vocabulary), "chunk int, counters binary"))
    counters = summed_counters(passed.where("chunk is not null"))
    texts, total, frequency = int(counters[0]), int(counters[1]), counters[2:]
    weights = np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * f + 1))) for f in frequency.tolist()], dtype=np.int64)
    rank_of = np.empty(len(vocabulary), dtype=np.int64)
    rank_of[np.argsort(-frequency, kind="stable")] = np.arange(len(vocabulary))
    numbered = [(item, np.searchsorted(vocabulary, own)) for item, own in terms.items() if len(own)]
    return passed.where("chunk is null").select("counters").mapInArrow(
        _searched(numbered, rank_of, weights, texts, max(total, 1), top), "item_id long, score long, doc_id long"
    )


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    top: int = TOP,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` documents of every item.

    Scores are above 0; equal ones rank by ascending id, null ids last; each row of ``docs`` is a
    document of its own, repeated ids and texts too.  Rows of ``items`` with one id are one item
    with all their terms, null ids too.  Null texts have no terms; an item without terms, or
    without a document that has one, gives no rows, as does an empty table.  Very long texts are
    read whole.  Other columns are ignored; ids are longs.  Terms are named by 64-bit hashes.

    The items are the bounded side: groups of about ``ITEM_BYTES`` of their texts are searched for
    one after another, each in two passes over the documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + size // ITEM_BYTES
    own = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    found = spark.createDataFrame([], "item_id long, score long, doc_id long")
    for group in range(groups):
        ranked = _search_group(rows, [tuple(row) for row in asked.where(own == group).collect()], top)
        found = found if ranked is None else found.unionByName(ranked)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    some = F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))
    last = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return (
        found.withColumn("part", part)
        .withColumn("rank", some)
        .where(F.col("rank") <= top)
        .withColumn("rank", last)
        .where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )
