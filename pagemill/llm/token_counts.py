"""Token counts by heap-and-linked-list byte-pair merging.

A piece of the pre-tokenizer starts as its bytes.  A heap holds the adjacent pairs by merge rank;
the lowest is popped and merged in a linked list, its new neighbours are pushed, and stale entries
are skipped.  The count is bytes minus merges; no ids are made.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import Memo
from pagemill.llm.pieces import PieceTable, windows
from pagemill.llm.tokens import tokenizer_path

LIMIT = 512
#: Words kept in each half of a worker's memo.
MEMO_WORDS = 300_000
#: Size of the memo of pieces.
MEMO = 4


def _byte_symbols() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: printable ones as they
    are, the others from 256 upwards."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


class Counter:
    """Counts tokens by the merge table of a byte-level ``tokenizers`` file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        number: dict[str, int] = {}
        symbols = _byte_symbols()
        for symbol in symbols:
            number[symbol] = len(number)
        #: (left << 32 | right) -> (rank, merged)
        self._merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(parsed["model"]["merges"]):
            merged = number.setdefault(left + right, len(number))
            pair = number.setdefault(left, len(number)) << 32 | number.setdefault(right, len(number))
            self._merges.setdefault(pair, (rank, merged))
        specials = [token["content"] for token in parsed["added_tokens"]]
        longest_first = sorted(map(re.escape, specials), key=len, reverse=True)
        self._special = re.compile("|".join(longest_first)) if specials else None
        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self._words = Memo(self.merge, MEMO_WORDS)
        add_up = lambda counts: np.array([np.sum(counts)], dtype=np.uint32)
        self._table = PieceTable(self._counts, add_up, memo=MEMO, specials=specials)

    def merge(self, word: str) -> int:
        """Tokens of one piece of the pre-tokenizer."""
        symbols: list[int] = list(word.encode())  # a byte's symbol has the byte's number
        count = size = len(symbols)
        if size < 2:
            return size
        merges = self._merges
        following = list(range(1, size + 1))
        preceding = list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != left or j >= size or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            count -= 1
            following[i] = k = following[j]
            if k < size:
                preceding[k] = i
                found = merges.get(merged << 32 | symbols[k])
                if found:
                    heapq.heappush(heap, (found[0], i, merged, symbols[k], found[1]))
            p = preceding[i]
            if p >= 0:
                found = merges.get(symbols[p] << 32 | merged)
                if found:
                    heapq.heappush(heap, (found[0], p, symbols[p], merged, found[1]))
        return count

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(map(self._words.__getitem__, self._pattern.findall(text)))

    def whole(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token, as by the library."""
        if self._special is None:
            return self.plain(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def _counts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array([self.whole(text)], dtype=np.uint32) for text in texts]

    def batch(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        for which, parts, goes_on in windows(texts):
            counts, starts, _, number, begins = self._table.window(parts, goes_on)
            sums = np.concatenate(([0], np.cumsum(counts[starts[number]], dtype=np.int64)))
            np.add.at(total, which, sums[begins[1:]] - sums[begins[:-1]])
        return total


_counters: dict[str, Counter] = {}


def _counted(path: str, limit: int):
    def run(batches):
        if path not in _counters:
            _counters[path] = Counter(path)
        count = _counters[path].batch
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = count(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document.

    A null or empty text has no tokens; rows that repeat an id are counted each; an empty table
    gives an empty result; other columns are ignored; ids are longs.  Memory beside the text is
    bounded by the memos.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return texts.mapInArrow(_counted(path or tokenizer_path(), limit), schema)
