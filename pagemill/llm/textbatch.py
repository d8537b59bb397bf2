"""Words of many texts at a time: Arrow string columns cut into windows, words hashed by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pagemill.llm.common import _EXACT, _FOLDED, _SPACE, _WINDOW, _power_tables, mix

_BYTES = np.arange(256)
#: Bytes of words ``[^\x20\x09-\x0D]+``.
IN_WORD = ~_SPACE
#: Bytes of terms: ASCII letters and digits and all of any other character.
IN_TERM = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90))
    | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)
#: Bytes with A-Z lower-cased.
LOWER = _BYTES.astype(np.uint8)
LOWER[65:91] += 32
#: Bytes of text worked on at a time; one longer text is a window of its own.
WINDOW_BYTES = 2 << 20


def text_windows(texts: pa.Array, size: int = WINDOW_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of whole texts; a newline ends each, null is empty.

    Text ``i`` of a window is ``bytes[offsets[i] : offsets[i + 1] - 1]``.
    """
    if not len(texts):
        return
    plain = pc.fill_null(texts, "").cast(pa.large_string())
    kind = pa.large_string()
    ended = pc.binary_join_element_wise(plain, pa.scalar("", kind), pa.scalar("\n", kind))
    _, places, content = ended.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[ended.offset :][: len(ended) + 1]
    data = np.frombuffer(content, dtype=np.uint8)
    first = 0
    while first < len(ended):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(ended))
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


def hashed_words(data: np.ndarray, inside: np.ndarray = IN_WORD, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(byte start, 64-bit hash) of each run of ``inside`` bytes; ``fold`` lower-cases A-Z first."""
    marks = np.zeros(len(data) + 2, dtype=np.int8)
    marks[1:-1] = inside[data]
    edges = np.diff(marks)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    table, first = _FOLDED if fold else _EXACT, 0
    hashes = np.zeros(len(starts), dtype=np.uint64)
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + _WINDOW, side="right")))
        piece = data[origin : ends[last - 1]]
        powers, inverses = _power_tables(max(len(piece), min(_WINDOW, 1 << 15)))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(table[piece] * powers[: len(piece)], out=sums[1:])
        begin, end = starts[first:last] - origin, ends[first:last] - origin
        hashes[first:last] = mix((sums[end] - sums[begin]) * inverses[begin])
        first = last
    return starts, hashes


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``counts[i]`` numbers) for all ``i``, one after another."""
    counts = np.asarray(counts, dtype=np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - counts), counts)


class Lookup:
    """Positions of 64-bit keys in a sorted table of distinct ones; most misses end at a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, dtype=np.uint64)
        self._bits = np.zeros(1 << 20, dtype=bool)
        self._bits[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``keys`` are in the table, their positions in it)."""
        which = np.flatnonzero(self._bits[self._slot(keys)])
        if not len(which):
            return which, which
        place = np.searchsorted(self.keys, keys[which])
        place[place == len(self.keys)] = 0
        found = self.keys[place] == keys[which]
        return which[found], place[found]
