"""Token ids of texts by the tokenizers library, which sees each distinct piece once."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pagemill.llm.pieces import PieceTable, windows

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Pieces that one call of the library is given.
TOGETHER = 64


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(values: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.uint32), *values])


class Encoder:
    """The library's ids of whole texts, as little-endian unsigned 32-bit bytes.

    ``memo`` is the size of its memo, the usual one being 1.
    """

    def __init__(self, path: str, memo: int = 1):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        specials = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._table = PieceTable(self.wholes, _joined, self.pieces, memo, specials)
        vocabulary = self._tokenizer.get_vocab()
        # In a byte-level vocabulary a space is written as Ġ and a newline as Ċ.
        self._begins = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._begins[[i for token, i in vocabulary.items() if token[:1] in ("Ġ", "Ċ")]] = True

    def wholes(self, texts: list[str]) -> list[np.ndarray]:
        """Each by itself."""
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype=np.uint32) for one in found]

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of pieces that begin with their only space or newline and may be put together."""
        groups = [texts[first : first + TOGETHER] for first in range(0, len(texts), TOGETHER)]
        found = [self.wholes(["".join(group)])[0] for group in groups]
        flat = _joined(found)
        begins = np.flatnonzero(self._begins[flat])
        ends = np.cumsum(list(map(len, found)), dtype=np.int64)
        right = np.diff(np.searchsorted(begins, ends), prepend=0) == list(map(len, groups))
        if right.all():
            return flat, np.diff(begins, append=len(flat))
        parts, sizes = [], []
        for group, ids, well in zip(groups, found, right.tolist()):
            alone = np.split(ids, np.flatnonzero(self._begins[ids])[1:]) if well else self.wholes(group)
            parts += alone
            sizes += map(len, alone)
        return _joined(parts), np.array(sizes, dtype=np.int64)

    def batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        waiting: list[bytes] = []
        current = 0
        for which, parts, goes_on in windows(texts):
            flat, starts, sizes, number, begins = self._table.window(parts, goes_on)
            lengths = sizes[number]
            ends = np.concatenate(([0], np.cumsum(lengths)))
            # Places in ``flat`` rise by one within a piece and jump from its end to the next start.
            narrow = np.int32 if max(int(ends[-1]), len(flat)) < 1 << 31 else np.int64
            source = np.repeat((starts[number] - ends[:-1]).astype(narrow), lengths)
            source += np.arange(ends[-1], dtype=narrow)
            ids = flat[source].astype("<u4", copy=False).tobytes()
            bounds = (4 * ends[begins]).tolist()
            for i, a, b in zip(which, bounds, bounds[1:]):
                if i != current:
                    yield b"".join(waiting)
                    waiting, current = [], i
                waiting.append(ids[a:b])
        if waiting:
            yield b"".join(waiting)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, memo: int = 1) -> Encoder:
    """One encoder per worker process, of the file and size of memo asked for last."""
    if (path, memo) not in _encoders:
        _encoders.clear()
        # What earlier stages left unused in this worker goes back before the memo grows.
        pa.default_memory_pool().release_unused()
        _encoders[path, memo] = Encoder(path, memo)
    return _encoders[path, memo]


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4")


def each_text(column) -> Iterator[str | None]:
    """The texts of an Arrow column one at a time, so that Python holds no more than a window."""
    return (text.as_py() for text in column)
