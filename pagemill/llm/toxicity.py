"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of the labelled rows.  Features are the words of a text and the
five-byte strings inside its words, so that a stem is met under any ending; the ``FEATURES`` that
speak most for the toxic label in the sample (chi-square) are weighed by (1 + ln tf) * idf and
scaled to length 1.  They are proposed by some of the examples and chosen by all.  The examples' vectors stand in an inverted index whose postings are cut into
blocks of examples; each entry keeps the largest weight of its feature in the block.  For a text,
the blocks' sums of these maxima bound every cosine in them, so blocks that cannot reach the
current k-th neighbour are left unread, and the neighbours are exact.

The vote of the k nearest is weighted by 1 / (distance + a constant).  Votes of the examples
themselves, each without its own entry, give the calibration: the share of toxic examples among
those with a similar vote, monotone in the vote.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.textbatch import IN_TERM, LOWER, Lookup, hashed_words, ranges, text_windows

#: Bound of the sample: so many examples of each label at most, the first by a hash of their id.
EXAMPLES = {1: 4_000, 0: 16_000}
#: So many of each label propose features, this many at most ...
PROPOSERS = 4_000
PROPOSED = 4_096
#: ... of which those are kept that stand out among all examples.  The least chi-square is that of
#: one chance in ten million, as about a million features are looked at.  A feature that is not
#: so many times as frequent in toxic examples as in others says little, however sure that is,
#: and stands in most texts.
FEATURES = 512
LEAST_CHI = 28.4
LEAST_LIFT = 5
LEAST_EXAMPLES = 4
GRAM = 5
BLOCK = 64
NEIGHBOURS = 15
#: Added to a distance, so that an equal example does not outvote all others.
_NEAR = 0.05
_WORD_MARK = np.uint64(1 << 63)


# --- features ---------------------------------------------------------------------------


def _keys(offsets: np.ndarray, data: np.ndarray, wanted: Lookup | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of every word and inner five-byte string, or of those ``wanted``.

    A word's key is its hash with the highest bit set, a string's the number its bytes spell.
    """
    starts, words = hashed_words(data, IN_TERM, fold=True)
    words |= _WORD_MARK
    low = LOWER[data].astype(np.uint64)
    count = max(0, len(data) - GRAM + 1)
    grams = np.zeros(count, dtype=np.uint64)
    for k in range(GRAM):
        grams = grams << np.uint64(8) | low[k : k + count]
    outside = np.concatenate(([0], np.cumsum(~IN_TERM[data])))
    within = np.flatnonzero(outside[GRAM:] == outside[: count]) if count else np.zeros(0, np.int64)
    grams = grams[within]
    if wanted is not None:
        which, _ = wanted.find(words)
        starts, words = starts[which], words[which]
        which, _ = wanted.find(grams)
        within, grams = within[which], grams[which]
    places, keys = np.concatenate((starts, within)), np.concatenate((words, grams))
    return np.searchsorted(offsets, places, side="right") - 1, keys


def _counts(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key) in order, and how often each comes."""
    if not len(text):
        return text, key, np.zeros(0, dtype=np.int64)
    by = np.lexsort((key, text))
    text, key = text[by], key[by]
    heads = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]))))
    return text[heads], key[heads], np.diff(np.append(heads, len(text)))


def _labelled_features(features: np.ndarray | None = None):
    """(key, toxic, other): in how many examples of a batch, by label, a feature stands."""

    def run(batches):
        wanted = None if features is None else Lookup(features)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, offsets, data in text_windows(batch.column(2)):
                text, key, _ = _counts(*_keys(offsets, data, wanted))
                keys, which = np.unique(key, return_inverse=True)
                bad = toxic[first + text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.bincount(which[bad], minlength=len(keys)).astype(np.int64)),
                        pa.array(np.bincount(which[~bad], minlength=len(keys)).astype(np.int64)),
                    ],
                    names=["key", "toxic", "other"],
                )

    return run


def _telling(sample: DataFrame, limit: int, features: np.ndarray | None = None) -> np.ndarray:
    """At most ``limit`` features, sorted, that stand out in toxic examples, by chi-square."""
    sizes = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    bad, good = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    held = (
        sample.select("doc_id", "toxic", "text")
        .mapInArrow(_labelled_features(features), "key long, toxic long, other long")
        .groupBy("key")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    )
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    differ = a * good - b * bad
    chi = (bad + good) * differ * differ / ((a + b) * F.greatest(bad + good - a - b, F.lit(1.0)) * max(bad * good, 1.0))
    best = (
        held.select("key", chi.alias("chi"), (a * good > b * bad * LEAST_LIFT).alias("toxic"), (a + b).alias("examples"))
        .where(F.col("toxic") & (F.col("chi") >= LEAST_CHI) & (F.col("examples") >= LEAST_EXAMPLES))
        .orderBy(F.col("chi").desc(), "key")
        .limit(limit)
    )
    return np.sort(np.array([row.key for row in best.collect()], dtype=np.int64).view(np.uint64))


def _labelled_vectors(features: np.ndarray):
    """(id, toxic, keys, tfs) of each example, of ``features`` alone."""

    def run(batches):
        wanted = Lookup(features)
        for batch in batches:
            for first, offsets, data in text_windows(batch.column(2)):
                text, key, times = _counts(*_keys(offsets, data, wanted))
                edges = np.searchsorted(text, np.arange(len(offsets))).tolist()
                spans = list(zip(edges, edges[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(spans)),
                        batch.column(1).slice(first, len(spans)),
                        pa.array([key[a:b].astype("<u8").tobytes() for a, b in spans], pa.binary()),
                        pa.array([times[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["doc_id", "toxic", "keys", "times"],
                )

    return run


# --- the index --------------------------------------------------------------------------


class Index:
    """Labelled examples as unit TF-IDF vectors under a block-max inverted index.

    ``example``, ``key`` and ``times`` are the entries, ``toxic`` the label per example.
    """

    def __init__(self, ids, toxic: np.ndarray, example: np.ndarray, key: np.ndarray, times: np.ndarray):
        count = len(toxic)
        self.keys = np.unique(key)
        feature = np.searchsorted(self.keys, key)
        held = np.bincount(feature, minlength=len(self.keys))
        self._idf = 1.0 + np.log((1.0 + count) / (1.0 + held))
        self.lookup = Lookup(self.keys)
        # Examples that share their strongest features stand together, so that blocks are alike.
        weight = self._weights(feature, times)
        norm = np.sqrt(np.bincount(example, weight * weight, minlength=count))
        weight = weight / norm[example]
        by = np.lexsort((feature, -weight, example))
        ends = np.searchsorted(example[by], np.arange(count + 1)).tolist()
        strongest = feature[by].tolist()
        order = sorted(range(count), key=lambda i: (strongest[ends[i] : ends[i + 1]], ids[i]))
        order = np.array(order, dtype=np.int64)
        number = np.empty(count, dtype=np.int64)
        number[order] = np.arange(count)
        self.ids, self.toxic, example = ids[order], toxic[order], number[example]
        self.empty = np.ones(count, dtype=bool)
        self.empty[example] = False
        by = np.lexsort((example, feature))
        self._example, self._weight, feature = example[by], weight[by], feature[by]
        block = self._example // BLOCK
        cell = np.concatenate(([True], (feature[1:] != feature[:-1]) | (block[1:] != block[:-1]))) if len(by) else []
        self._start = np.flatnonzero(cell)
        self._count = np.diff(np.append(self._start, len(by)))
        self._block = block[self._start]
        self._most = np.maximum.reduceat(self._weight, self._start) if len(by) else np.zeros(0)
        self._cells = np.searchsorted(feature[self._start], np.arange(len(self.keys) + 1))
        self._blocks = -(-count // BLOCK)
        self._fit()

    def _weights(self, feature: np.ndarray, times: np.ndarray) -> np.ndarray:
        return (1.0 + np.log(times)) * self._idf[feature]

    def vector(self, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, unit weights) of a text's counted keys; all keys are in the index."""
        feature = np.searchsorted(self.keys, key)
        weight = self._weights(feature, times)
        return feature, weight / np.sqrt((weight * weight).sum())

    def nearest(self, feature: np.ndarray, weight: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``NEIGHBOURS`` highest cosines above 0, equal ones by id.

        Cosines are rounded to nine digits, so equal vectors tie whatever the order of sums.
        """
        cells = ranges(self._cells[feature], self._cells[feature + 1] - self._cells[feature])
        each = np.repeat(weight, self._cells[feature + 1] - self._cells[feature])
        blocks = self._block[cells]
        bound = np.bincount(blocks, each * self._most[cells], minlength=self._blocks) + 1e-8
        order = np.argsort(-bound, kind="stable")
        found, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        step, at = 2, 0
        while at < len(order):
            least = cosines[-1] if len(found) == NEIGHBOURS else 0.0
            some = order[at : at + step]
            some = some[(bound[some] >= least) & (bound[some] > 1e-8)]
            if not len(some):
                break
            chosen = np.isin(blocks, some)
            count = self._count[cells[chosen]]
            entries = ranges(self._start[cells[chosen]], count)
            examples, which = np.unique(self._example[entries], return_inverse=True)
            sums = np.bincount(which, np.repeat(each[chosen], count) * self._weight[entries])
            keep = examples != skip
            found = np.concatenate((found, examples[keep]))
            cosines = np.concatenate((cosines, np.round(np.minimum(sums[keep], 1.0), 9)))
            by = np.lexsort((self.ids[found], -cosines))[:NEIGHBOURS]
            found, cosines = found[by], cosines[by]
            at, step = at + step, step * 4
        return found, cosines

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """Toxic share of the neighbours, weighted by distance; -1 without any."""
        if not len(found):
            return -1.0
        near = 1.0 / (1.0 - cosines + _NEAR)
        return float((near * self.toxic[found]).sum() / near.sum())

    def _fit(self) -> None:
        """Monotone calibration from the examples' own votes (pool adjacent violators)."""
        by = np.lexsort((np.arange(len(self._example)), self._example))
        feature = np.repeat(np.arange(len(self.keys)), np.diff(np.append(
            np.append(self._start, len(self._example))[self._cells[:-1]], len(self._example))))
        edges = np.searchsorted(self._example[by], np.arange(len(self.ids) + 1))
        votes = np.empty(len(self.ids))
        for i in range(len(self.ids)):
            own = by[edges[i] : edges[i + 1]]
            votes[i] = self.vote(*self.nearest(feature[own], self._weight[own], skip=i)) if len(own) else -1.0
        # One pseudo-example of either label keeps shares inside (0, 1).
        levels, which = np.unique(votes, return_inverse=True)
        total = np.bincount(which, minlength=len(levels)).astype(float)
        bad = np.bincount(which, self.toxic, minlength=len(levels)).astype(float)
        pools: list[list[float]] = []
        for level, t, b in zip(levels.tolist(), total.tolist(), bad.tolist()):
            pools.append([level, t, b])
            while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
                _, t, b = pools.pop()
                pools[-1][1] += t
                pools[-1][2] += b
        self._floors = np.array([p[0] for p in pools])
        shares = (np.array([p[2] for p in pools]) + 1.0) / (np.array([p[1] for p in pools]) + 2.0)
        self._shares = np.maximum.accumulate(shares) if len(pools) else shares

    def score(self, vote: float) -> float:
        if not len(self._floors):
            return 0.0
        return float(self._shares[max(0, int(np.searchsorted(self._floors, vote, side="right")) - 1)])


def _scored(index: Index):
    def run(batches):
        for batch in batches:
            for first, offsets, data in text_windows(batch.column(1)):
                size = len(offsets) - 1
                text, key, times = _counts(*_keys(offsets, data, index.lookup))
                edges = np.searchsorted(text, np.arange(size + 1)).tolist()
                plain = index.score(-1.0)
                scores, ids, cosines = [plain] * size, [[]] * size, [[]] * size
                for i in range(size):
                    own = slice(edges[i], edges[i + 1])
                    if own.start < own.stop:
                        found, near = index.nearest(*index.vector(key[own], times[own]))
                        scores[i] = index.score(index.vote(found, near))
                        ids[i], cosines[i] = index.ids[found].tolist(), near.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, size),
                        pa.array(scores, pa.float64()),
                        pa.array(ids, pa.list_(pa.int64())),
                        pa.array(cosines, pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "score", "neighbours", "cosines"],
                )

    return run


# --- Spark ------------------------------------------------------------------------------


def held_out(id_column: str = "doc_id"):
    """Whether crc32(id as text) mod 5 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def examples_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``doc_id``, ``toxic``, ``proposes``, ``text``) of the sample, of at most ``EXAMPLES`` rows.

    Of rows that repeat an id, the largest label and the largest text count; rows without an id,
    a label of 0 or 1, or a text, and those held out, are no examples.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = [known.where(F.col("toxic") == label).orderBy(*by).limit(most) for label, most in EXAMPLES.items()]
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(*by))
    chosen = some[0].unionByName(some[1]).withColumn("proposes", place <= PROPOSERS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    # The sample's ids are at most so many as EXAMPLES says, so the hint is bounded.
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic", "proposes")
        .agg(F.max("text").alias("text"))
    )


def fit(docs: DataFrame, labels: DataFrame) -> Index:
    """The index of the sample: vectors of at most ``FEATURES`` entries."""
    sample = examples_of(docs, labels).persist()
    try:
        proposed = _telling(sample.where("proposes"), PROPOSED)
        features = _telling(sample, FEATURES, proposed)
        examples = sample.select("doc_id", "toxic", "text")
        rows = examples.mapInArrow(_labelled_vectors(features), "doc_id long, toxic int, keys binary, times binary").collect()
    finally:
        sample.unpersist()
    rows.sort(key=lambda row: row.doc_id)
    keys = [np.frombuffer(row["keys"], "<u8") for row in rows]
    return Index(
        np.array([row.doc_id for row in rows], dtype=np.int64),
        np.array([row.toxic for row in rows], dtype=np.int64),
        np.repeat(np.arange(len(rows)), [len(k) for k in keys]),
        np.concatenate(keys) if keys else np.zeros(0, np.uint64),
        np.concatenate([np.frombuffer(row["times"], "<i8") for row in rows]) if rows else np.zeros(0, np.int64),
    )


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the evidence of every row of ``docs``.

    ``neighbours`` are the ids of the examples that voted and ``cosines`` their closeness.  A text
    without any feature, a null or empty one too, has no neighbours and the score of the examples
    without features.  Without labels every score is 0.  Rows that repeat an id are scored each;
    ids are longs and may be null; an empty table gives an empty result; texts are read whole,
    very long ones too; other columns are ignored.
    """
    index = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, score double, neighbours array<long>, cosines array<double>"
    scored = texts.mapInArrow(_scored(index), schema)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "neighbours", "cosines",
    )
