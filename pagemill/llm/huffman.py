"""Token files: canonical, length-limited Huffman codes of ids from global counts.

A token file is a folder with ``codebook`` (``id``, ``bits``: a canonical code needs no more) and
``blocks``.  A block is a row that is read by itself: the documents in it in ascending id order,
their token counts, the number of ids before it, the code bits, and the bit offset of every
``STRIDE``-th token of each document.  Decoding follows all offsets of a block at once through one
table that maps the next ``MAX_BITS`` bits to an id and its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import counter_chunks, new_folder, rows_of, summed_counters
from pagemill.llm.tokens import END_ID, as_ids, each_text, encoder, tokenizer_path

#: Longest code; the decoding table has 2^MAX_BITS entries.
MAX_BITS = 20
#: Bits of an id in the decoding table; the five above it hold the length of its code.
ID_BITS = 27
ID_MASK = np.uint32((1 << ID_BITS) - 1)
#: Tokens between two bit offsets.
STRIDE = 256
#: A block ends with the document that brings it to so many tokens.
BLOCK_TOKENS = 1 << 18
#: Tokens of a part, that is of one sorted file of blocks, on average.
PART_TOKENS = 16 << 20
#: Size of the encoder's memo: a task holds little else.
MEMO = 4
_STAGE = "doc_id long, row long, n_tokens long, ids binary, chunk int, counters binary"
_CODED = "part int, doc_id long, row long, n_tokens long, bits binary, offsets binary"
_BLOCK = (
    "part int, block int, first_id long, doc_ids array<long>, n_tokens array<long>, "
    "offsets binary, payload binary"
)


# --- codes -----------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 where unused."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaf_first, merged = [], weights
    masks = [np.ones(len(weights), dtype=bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weights, pairs))
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        masks.append(rank < len(weights))
    depth = np.zeros(len(weights), dtype=np.int64)
    take = 2 * len(weights) - 2
    for mask in reversed(masks):
        leaves = int(np.count_nonzero(mask[:take]))
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    code = previous = 0
    for i in order.tolist():
        code <<= int(lengths[i]) - previous
        previous = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """The id, and above it the code's length, for every value of the next ``limit`` bits."""
    table = np.zeros(1 << limit, dtype=np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    span = (1 << limit) >> lengths[order].astype(np.int64)
    filled = int(span.sum())
    table[:filled] = np.repeat(order.astype(np.uint32) | lengths[order].astype(np.uint32) << ID_BITS, span)
    return table


def left_aligned(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Codes at the top of 64 bits."""
    return codes << (np.uint64(64) - lengths.astype(np.uint64)) % np.uint64(64)  # unused ids have code 0


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits, bit offsets of every ``STRIDE``-th id)."""
    return encode_aligned(ids, left_aligned(codes, lengths), lengths)


def encode_aligned(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``encode`` by ``left_aligned`` codes."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    word = starts >> 5
    value = codes[ids] >> (starts & 31).astype(np.uint64)
    out = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    # Codes do not overlap, so their sum has the bits of all that begin in a word.
    bits, word = np.add.reduceat(value, first), word[first]
    out[word] += bits >> np.uint64(32)
    out[word + 1] += bits & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8], starts[::STRIDE]


def decode(payload: bytes, offsets: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """The ids of the runs of ``counts`` ids that start at the bit ``offsets``, in order."""
    data = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    ahead = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    order = np.argsort(-counts, kind="stable")
    position, left = offsets[order].astype(np.int64), counts[order]
    into = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), dtype=np.uint32)
    steps = int(left[0]) if len(left) else 0
    for step, live in enumerate(np.searchsorted(-left, -np.arange(steps), side="left").tolist()):
        at = position[:live]
        window = (ahead[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        found = table[window]
        out[into[:live] + step] = found & ID_MASK
        at += found >> ID_BITS
    return out


# --- writing ---------------------------------------------------------------------------


def _stage(path: str, end_id: int, vocabulary: int):
    narrow = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        encode_texts = encoder(path, MEMO).batch
        counters = np.zeros(vocabulary, dtype=np.int64)
        row = TaskContext.get().partitionId() << 33
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids, sizes, rows, blobs, fresh, held = batch.column(0).to_pylist(), [], [], [], [], 0
            for raw in encode_texts(each_text(batch.column(1))):
                tokens = as_ids(raw + end)
                fresh.append(tokens)
                held += len(tokens)
                if held > 1 << 20:
                    counters += np.bincount(np.concatenate(fresh), minlength=vocabulary)
                    fresh, held = [], 0
                sizes.append(len(tokens))
                rows.append(row)
                blobs.append(tokens.astype(narrow).tobytes())
                row += 1
            if fresh:
                counters += np.bincount(np.concatenate(fresh), minlength=vocabulary)
            yield _staged(ids, rows, sizes, blobs, [None] * len(ids), [None] * len(ids))
        chunks = counter_chunks(counters)
        none = [None] * len(chunks)
        yield _staged(none, none, none, none, range(len(chunks)), chunks)

    return run


def _staged(*columns):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds)],
        names=["doc_id", "row", "n_tokens", "ids", "chunk", "counters"],
    )


def _place(doc_id: int | None, row: int) -> tuple:
    return (doc_id is not None, doc_id or 0, row)


def _code(lengths: np.ndarray, bounds: list[tuple], vocabulary: int):
    narrow = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        codes = left_aligned(canonical_codes(lengths), lengths)
        for batch in batches:
            out = []
            for doc_id, row, n_tokens, raw in rows_of([batch], "doc_id", "row", "n_tokens", "ids"):
                bits, offsets = encode_aligned(np.frombuffer(raw, dtype=narrow), codes, lengths)
                part = bisect_left(bounds, _place(doc_id, row))
                out.append((part, doc_id, row, n_tokens, bits, offsets.astype("<u8").tobytes()))
            if out:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)],
                    names=["part", "doc_id", "row", "n_tokens", "bits", "offsets"],
                )

    return run


def _assemble(first_ids: list[int]):
    def run(batches):
        block, held, ids, sizes, offsets, payload, length = 0, 0, [], [], [], [], 0
        part = start = None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([np.concatenate(offsets).astype("<u8").tobytes()], pa.binary()),
                 pa.array([b"".join(payload)], pa.binary())],
                names=["part", "block", "first_id", "doc_ids", "n_tokens", "offsets", "payload"],
            )

        for number, doc_id, n_tokens, bits, own in rows_of(
            batches, "part", "doc_id", "n_tokens", "bits", "offsets"
        ):
            if part != number:
                if ids:
                    yield row()
                    ids, sizes, offsets, payload, length, held = [], [], [], [], 0, 0
                part, block, start = number, 0, first_ids[number]
            ids.append(doc_id)
            sizes.append(n_tokens)
            offsets.append(np.frombuffer(own, dtype="<u8") + np.uint64(8 * length))
            payload.append(bits)
            length += len(bits)
            held += n_tokens
            if held >= BLOCK_TOKENS:
                yield row()
                start, block = start + held, block + 1
                ids, sizes, offsets, payload, length, held = [], [], [], [], 0, 0
        if ids:
            yield row()

    return run


def write_token_file(
    docs: DataFrame,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
) -> str:
    """Write the ids of all documents, each with its end id, in ascending id order.

    Texts are encoded once; their ids wait beside the file in ``staged`` until the global counts
    are known.  A null or empty text is its end id alone; null ids come first; rows that repeat
    an id stand in the order in which they were read; an empty table makes an empty file.
    """
    import json

    spark, path = docs.sparkSession, path or tokenizer_path()
    with open(path, encoding="utf-8") as file:
        vocabulary = max(json.load(file)["model"]["vocab"].values()) + 1 + 1024  # added tokens
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    staged = texts.mapInArrow(_stage(path, end_id, vocabulary), _STAGE)
    staged.write.option("compression", "zstd").parquet(f"{folder}/staged")
    staged = spark.read.schema(_STAGE).parquet(f"{folder}/staged")
    documents = staged.where("chunk is null").drop("chunk", "counters")
    counters = staged.where("chunk is not null").select("chunk", "counters")
    counts = summed_counters(counters) if not counters.isEmpty() else np.zeros(vocabulary, np.int64)
    lengths = code_lengths(counts)
    book = [(i, int(lengths[i])) for i in np.flatnonzero(lengths).tolist()]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    # Only ids and counts are ranged: the largest (id, row) of each part bounds it.
    n_parts = max(1, -(-int(counts.sum()) // PART_TOKENS))
    ranged = (
        documents.select("doc_id", "row", "n_tokens")
        .repartitionByRange(n_parts, F.col("doc_id").asc_nulls_first(), "row")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.sum("n_tokens").alias("tokens"))
    )
    parts = sorted(ranged.collect(), key=lambda r: _place(r["last"]["doc_id"], r["last"]["row"]))
    bounds = [_place(part["last"]["doc_id"], part["last"]["row"]) for part in parts]
    first_ids = [0]
    for part in parts:
        first_ids.append(first_ids[-1] + part["tokens"])
    (
        documents.mapInArrow(_code(lengths, bounds, vocabulary), _CODED)
        .repartitionById(max(1, len(parts)), F.col("part"))
        .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "row")
        .mapInArrow(_assemble(first_ids), _BLOCK)
        .write.option("compression", "none")
        .parquet(f"{folder}/blocks")
    )
    return folder


# --- reading ---------------------------------------------------------------------------


def _blocks(lengths: np.ndarray, keep_ids: bool):
    def run(batches):
        table = decoding_table(lengths)
        for row in rows_of(batches, "first_id", "doc_ids", "n_tokens", "offsets", "payload"):
            start, doc_ids, sizes, offsets, payload = row
            offsets = np.frombuffer(offsets, dtype="<u8")
            counts = np.array(sizes, dtype=np.int64)
            runs = -(-counts // STRIDE)
            run_sizes = np.full(int(runs.sum()), STRIDE, dtype=np.int64)
            run_sizes[np.cumsum(runs) - 1] = counts - (runs - 1) * STRIDE
            ids = decode(payload, offsets, run_sizes, table).astype("<u4").tobytes()
            ends = np.cumsum(counts)
            begins = ends - counts
            pieces = [ids[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist())]
            columns = [
                pa.array(doc_ids, pa.int64()), pa.array(begins + start, pa.int64()), pa.array(counts),
                pa.array([zlib.crc32(piece) for piece in pieces], pa.int64()),
            ]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(pieces, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_file(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``[, ``ids``]) decoded from the blocks.

    ``ids`` are little-endian unsigned 32-bit.  The codebook, at most a vocabulary long, is read
    by the driver.
    """
    book = spark.read.schema("id int, bits int").parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max((row.id for row in book), default=0) + 1, dtype=np.uint8)
    for row in book:
        lengths[row.id] = row.bits
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    return blocks.mapInArrow(_blocks(lengths, keep_ids), schema)


def round_trip(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write ``docs`` to a token file in the shared folder and read it back, without the ids."""
    folder = write_token_file(docs, new_folder(docs.sparkSession, "tokens"), id_column, text_column)
    return read_token_file(docs.sparkSession, folder, keep_ids=False)
