"""N-gram Jaccard join by parity sketches.

A document is its set of shingle hashes.  The hash range is cut into cells; the sketch holds
the XOR of the hashes of each cell, that is 64 parity bits a cell.  A shingle in only one of two sets changes
one cell, so the cells in which two sketches differ are at most the symmetric difference, which
a Jaccard similarity of 0.8 or more bounds by (|A| + |B|) / 9.  Documents are compared within
bands of size.  With D the bound of a band and more than D cells, two similar documents agree
in all but D cells, so they share at least one of their D + 1 rarest cells, whatever the order
that says which cells are rare (pigeonhole).  Cells are ordered by counters of the shingles in
them, gathered over all documents, so that shared passages make no candidates.

Candidates are verified on whole sets.  Links are found in rounds: first every document of a
cell against one leader of the cell, then, among cells whose documents are not connected yet,
against other leaders, and last every pair of such a cell that no link path joins and the sketch
does not rule out.  So a large group of near copies costs its size and no link is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import (
    boxed, counter_chunks, cut_lineage, distinct_sorted, mix, narrow_side, rows_of, settled,
    shingle_hashes, summed_counters,
)
from pagemill.llm.components import connected_components

SHINGLE = 5
#: Counters of shingle hashes: a fixed table, 1 MB as longs, summed over all documents.
COUNTERS = 1 << 17
#: Cells of a band whose sets are small.
SMALL_SET, SMALL_CELLS = 48, 2048
#: Rounds against leaders before the remaining pairs are compared.
LEADER_ROUNDS = 2
#: 64-bit words of the parity sketch that is checked before sets are compared.
SKETCH_WORDS = 8
#: Words of the wider sketch that is compared before whole sets move, for pairs the first lets by.
#: It tells sets of thousands of shingles apart, whose bits fill the first.
WIDE_WORDS = 64
#: Distinct sets a task remembers in order to emit the cells of a copy once.
_SEEN = 1 << 20
_U64 = np.uint64


def _cells_of(low: int, bound: int) -> int:
    """So many cells that sets of ``low`` shingles or more fill over ``bound`` of them.

    Otherwise they would be filed under empty cells, which unrelated sets share.  The number of
    empty cells has to stay six standard deviations below what may be empty; more cells than
    that would hold one shingle each, which is more often shared than the parity of some.
    """
    cells = bound + 1 + (bound + 1) // 2
    if bound and low < SMALL_SET:
        return SMALL_CELLS
    while bound:
        load = low / cells
        empty = math.exp(-load)
        spread = math.sqrt(cells * empty * (1 - (1 + load) * empty))
        if cells * (1 - empty) - (bound + 1) >= 6 * spread:
            break
        cells += -(-cells // 16)
    return cells


def _bands() -> list[tuple[int, int, int, int, int]]:
    """(smallest, largest, largest partner, bound D, cells) of each size band.

    A pair belongs to the band of its smaller set.  A band ends at 25/16 of its start, so a
    partner, at most 5/4 as large, is in the same band or the next.
    """
    bands, low = [], 1
    while low < 1 << 40:
        high = max(low, low * 25 // 16)
        partner = high * 5 // 4
        bound = (high + partner) // 9
        bands.append((low, high, partner, bound, _cells_of(low, bound)))
        low = high + 1
    return bands


BANDS = _bands()
_LOWS = np.array([band[0] for band in BANDS])


def _bands_of(size: int) -> list[int]:
    own = int(np.searchsorted(_LOWS, size, side="right")) - 1
    return [own - 1, own] if own and size <= BANDS[own - 1][2] else [own]


def set_key(shingles: np.ndarray) -> int:
    """64 bits that name a set of shingles."""
    total = mix(shingles).sum(dtype=_U64, keepdims=True) + mix(np.array([len(shingles)], dtype=_U64))
    return int(mix(total).view(np.int64)[0])


def _summaries(batches):
    """(doc_id, n_shingles, key) per document, and the task's shingle counters in chunks."""
    counters = np.zeros(COUNTERS, dtype=np.int64)
    for batch in batches:
        ids, sizes, keys = batch.column(0), [], []
        for (text,) in rows_of([batch], "text"):
            shingles = shingle_hashes(text, SHINGLE)
            sizes.append(len(shingles))
            keys.append(set_key(shingles) if len(shingles) else None)
            slots = (shingles & _U64(COUNTERS - 1)).astype(np.int64)
            if len(slots) < COUNTERS // 8:
                np.add.at(counters, slots, 1)
            else:
                counters += np.bincount(slots, minlength=COUNTERS)
        nothing = pa.nulls(len(ids), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), nothing,
             pa.nulls(len(ids), pa.binary())],
            names=["doc_id", "n_shingles", "key", "chunk", "counters"],
        )
    chunks = counter_chunks(counters)
    none = pa.nulls(len(chunks), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, none, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())],
        names=["doc_id", "n_shingles", "key", "chunk", "counters"],
    )


def rarest_cells(shingles: np.ndarray, band: int, counters: np.ndarray) -> np.ndarray:
    """The D + 1 rarest cells of a sketch as 64-bit tokens of (band, cell, parity)."""
    bound, cells = BANDS[band][3:]
    cell = ((shingles >> _U64(32)) * _U64(cells)) >> _U64(32)  # rises with the sorted hash
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    parity = np.bitwise_xor.reduceat(shingles, first)
    rare = np.minimum.reduceat(counters[(shingles & _U64(COUNTERS - 1)).astype(np.int64)], first)
    used, place = cell[first], _U64(band << 40)
    tokens = mix(parity ^ mix(used + place))
    if len(first) > bound + 1:
        chosen = np.lexsort((tokens, rare))[: bound + 1]
        return tokens[chosen]
    # Empty cells come last in the order, by their token; they are taken only if cells run out.
    empty = np.ones(cells, dtype=bool)
    empty[used.astype(np.int64)] = False
    blank = np.sort(mix(mix(np.flatnonzero(empty).astype(_U64) + place)))
    return np.concatenate((tokens, blank[: bound + 1 - len(first)]))


def _cells(counters: np.ndarray):
    def emit(batches):
        seen: set[int] = set()
        for batch in batches:
            tokens, keys, held = [], [], 0
            for (text,) in rows_of([batch], "text"):
                shingles = shingle_hashes(text, SHINGLE)
                if not len(shingles):
                    continue
                key = set_key(shingles)
                if key in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
                for band in _bands_of(len(shingles)):
                    own = rarest_cells(shingles, band, counters)
                    tokens.append(own.view(np.int64))
                    keys.append(np.full(len(own), key, dtype=np.int64))
                    held += len(own)
                if held >= 1 << 18:
                    yield _token_batch(tokens, keys)
                    tokens, keys, held = [], [], 0
            if held:
                yield _token_batch(tokens, keys)

    return emit


def _token_batch(tokens, keys):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(keys))], names=["token", "key"]
    )


def parity_words(shingles: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """``words`` words of parity bits; differing bits bound the symmetric difference."""
    bits = (shingles >> _U64(7)) % _U64(64 * words)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(batches):
    for batch in batches:
        ids, keys, sizes, words, wide, blobs = batch.column(0), [], [], [], [], []
        for (text,) in rows_of([batch], "text"):
            shingles = shingle_hashes(text, SHINGLE)
            keys.append(set_key(shingles) if len(shingles) else None)
            sizes.append(len(shingles))
            words.append(parity_words(shingles))
            wide.append(parity_words(shingles, WIDE_WORDS))
            blobs.append(packed(shingles))
        sketch = np.array(words, dtype=np.int64).reshape(len(words), SKETCH_WORDS)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())]
            + [pa.array(sketch[:, i]) for i in range(SKETCH_WORDS)]
            + [pa.array(wide, pa.list_(pa.int64())), pa.array(blobs, pa.binary())],
            names=["doc_id", "key", "n", *(f"w{i}" for i in range(SKETCH_WORDS)), "wide", "shingles"],
        )


_SETS = "doc_id long, key long, n long, " + ", ".join(f"w{i} long" for i in range(SKETCH_WORDS)) + ", wide array<long>, shingles binary"


def packed(shingles: np.ndarray) -> bytes:
    """The leading 48 bits of each hash, which sets carry when they move to be compared.

    Two sets of n shingles then count a shingle too many with probability n^2 / 2^48.
    """
    return shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    wide[:, 2:] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(">u8").astype(_U64)


def _links(percent: int):
    def keep(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            found = []
            for left, right in rows_of([batch], "left", "right"):
                x, y = unpacked(left), unpacked(right)
                both = len(x) + len(y) - len(distinct_sorted(np.concatenate((x, y))))
                found.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["u", "v"])

    return keep


def _plausible(left: str, right: str) -> str:
    """SQL: neither size nor sketch rules out a similarity of 0.8."""
    differ = " + ".join(f"bit_count({left}.w{i} ^ {right}.w{i})" for i in range(SKETCH_WORDS))
    sizes = f"4 * {left}.n <= 5 * {right}.n and 4 * {right}.n <= 5 * {left}.n"
    return f"{sizes} and 9 * ({differ}) <= {left}.n + {right}.n"


def _with_both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the rows of ``v`` as ``a`` and of ``u`` as ``b``; sets in no pair stay."""
    left = sets.join(narrow_side(pairs.select(F.col("v").alias("key")).distinct(), 16), "key", "left_semi")
    right = sets.join(narrow_side(pairs.select(F.col("u").alias("key")).distinct(), 16), "key", "left_semi")
    joined = pairs.join(left.alias("a"), F.col("v") == F.col("a.key"))
    return joined.join(right.alias("b"), F.col("u") == F.col("b.key"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (``u``, ``v``) of ``pairs`` whose sets are similar.

    Sizes, sketches and then wider sketches rule pairs out, so only the sets of likely ones move.
    """
    words = ["n", *(f"w{i}" for i in range(SKETCH_WORDS))]
    narrow = narrow_side(sets.select("key", *words), 96)
    possible = settled(
        pairs.join(narrow.alias("a"), F.col("u") == F.col("a.key"))
        .join(narrow.alias("b"), F.col("v") == F.col("b.key"))
        .where(_plausible("a", "b"))
        .select("u", "v")
        .distinct()
    )
    unlike = F.aggregate(
        F.zip_with("a.wide", "b.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )
    likely = settled(
        _with_both(possible, sets.select("key", "n", "wide"))
        .where(9 * unlike <= F.col("a.n") + F.col("b.n"))
        .select("u", "v")
    )
    whole = _with_both(likely, sets.select("key", "shingles"))
    whole = whole.select("u", "v", F.col("a.shingles").alias("left"), F.col("b.shingles").alias("right"))
    return whole.mapInArrow(_links(80), "u long, v long")


def _shared_cells(cells: DataFrame) -> DataFrame:
    """(``token``, ``key``, ``leader``) of the cells that two or more sets share."""
    by_key = Window.partitionBy("token").orderBy("key")
    first = F.first("key").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        cells.select(
            "token", "key", first.alias("leader"),
            F.lag("key").over(by_key).alias("before"), F.lead("key").over(by_key).alias("after"),
        )
        .where("(key != leader and key != before) or (key = leader and key != after)")
        .select("token", "key", "leader")
    )


def _merge(labels: DataFrame, edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Labels (``key``, ``root``) after the components that ``edges`` of keys connect.

    Sets with one root are connected; after few ``rounds`` connected ones may still differ.
    """
    named = (
        edges.join(labels.alias("a"), F.col("u") == F.col("a.key"))
        .join(labels.alias("b"), F.col("v") == F.col("b.key"))
        .select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))
    )
    roots = connected_components(named, rounds)
    joined = labels.join(roots.withColumnRenamed("root", "higher"), F.col("root") == F.col("node"), "left")
    return settled(joined.select("key", F.coalesce("higher", "root").alias("root")))


def _open_cells(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(``token``, ``key``, ``root``) of what is left to compare in each cell.

    The leader of a cell has met all its sets, so it goes; so do cells whose other sets are
    connected.
    """
    rest = shared.where("key != leader").select("token", "key").join(narrow_side(labels, 32), "key")
    cell = Window.partitionBy("token")
    return (
        rest.withColumn("low", F.min("root").over(cell))
        .withColumn("high", F.max("root").over(cell))
        .where("low != high")
        .select("token", "key", "root")
    )


def _sets_of(texts: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The sets of ``keys`` with sizes and sketches, each from one document that is read again.

    That is the document with the smallest id.  Only where several rows have that id and the
    same set do sets move to be told apart.
    """
    own = rows.join(narrow_side(keys, 32), "key", "left_semi").groupBy("key", "doc_id")
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("count")))
    chosen = settled(
        own.count().groupBy("key").agg(least.alias("least"))
        .select("key", "least.id", (F.col("least.count") > 1).alias("repeated"))
    )
    ids = settled(chosen.select("id").distinct())
    again = texts.join(narrow_side(ids, 32), texts["doc_id"].eqNullSafe(ids["id"]), "left_semi")
    read = again.mapInArrow(_sets, _SETS).alias("a")
    read = read.join(
        narrow_side(chosen, 40).alias("b"),
        (F.col("a.key") == F.col("b.key")) & F.col("a.doc_id").eqNullSafe(F.col("b.id")),
    ).select("a.*", "b.repeated")
    read = cut_lineage(read)
    once = cut_lineage(read.where("repeated").dropDuplicates(["key"]))
    sets = read.where("not repeated").unionByName(once).drop("doc_id", "repeated")
    return sets.coalesce(max(1, -(-sets.count() // 2_000)))


def link_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents (``doc_id``, ``n_shingles``, ``key``), labels (``key``, ``root``)).

    Sets that occur in no label link with no other set.  A key is 64 bits of the set; two
    sets of N with one key would be taken for one, with probability N^2 / 2^65.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, n_shingles long, key long, chunk int, counters binary"
    summaries = cut_lineage(texts.mapInArrow(_summaries, schema))
    counters = summed_counters(summaries.where("chunk is not null").select("chunk", "counters"))
    rows = summaries.where("chunk is null").select("doc_id", "n_shingles", "key")
    cells = texts.select("text").mapInArrow(_cells(counters), "token long, key long")
    shared = settled(_shared_cells(cells), 1_000_000)
    keys = settled(shared.select("key").distinct())
    labels = keys.select("key", F.col("key").alias("root"))
    sets = _sets_of(texts, rows, keys)
    links, apart = None, labels
    for turn in range(1, LEADER_ROUNDS + 1):
        pairs = shared.where("key != leader" + (" and root != leader_root" if turn > 1 else ""))
        pairs = pairs.select(F.col("key").alias("u"), F.col("leader").alias("v")).distinct()
        found = settled(_verified(pairs, sets))
        links = found if links is None else settled(links.unionByName(found))
        labels = _merge(labels, found, rounds=1)
        shared = settled(_open_cells(shared, labels), 1_000_000)
        if turn < LEADER_ROUNDS:
            best = F.min(F.struct(F.xxhash64("key", F.lit(turn)), "key", "root"))
            first = best.over(Window.partitionBy("token"))
            shared = shared.withColumn("best", first).select(
                "token", "key", "root", F.col("best.key").alias("leader"), F.col("best.root").alias("leader_root")
            )
    sketched = shared.join(sets.drop("wide", "shingles"), "key")
    rest = (
        sketched.alias("a")
        .join(
            sketched.alias("b"),
            F.expr("a.token = b.token and a.root < b.root and " + _plausible("a", "b")),
        )
        .select(F.greatest("a.key", "b.key").alias("u"), F.least("a.key", "b.key").alias("v"))
        .distinct()
    )
    if not shared.isEmpty():
        links = links.unionByName(_verified(rest, sets))
    return rows, _merge(apart, links)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Component of every document under links of Jaccard similarity 0.8 or more.

    Returns ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by
    links.  A null or wordless text has no shingles and no links; a text of fewer than five
    words is one shingle; a null id counts as larger than any other and a component of null
    ids has none; repeated rows stay; an empty table gives an empty result; other columns are
    ignored.  Ids are longs.
    """
    rows, labels = link_classes(docs, id_column, text_column)
    classes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    named = classes.join(labels, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = named.select("key", "root").join(lowest, "root").select("key", "component_id")
    linked = rows.where("key is not null").join(by_key, "key")
    alone = rows.where("key is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def keep_one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: the row with its smallest id.

    Rows that repeat an id share its verdict.
    """
    verdict = near_duplicates(docs, id_column, text_column)
    dropped = cut_lineage(
        verdict.where("not (doc_id <=> component_id)").select(F.col("doc_id").alias("id")).distinct()
    )
    kept = boxed(docs).join(
        narrow_side(dropped, 16), F.col("doc")[id_column].eqNullSafe(F.col("id")), "left_anti"
    )
    return kept.select("doc.*")
