"""Texts as pieces that a byte-level pre-tokenizer treats apart, one value for each distinct piece.

The pre-tokenizer's pattern starts anew at a single space, and around a single newline, between
two characters that are not white space, whatever else stands around them, and where punctuation
follows a letter or digit.  So a text may be cut there, and what is worked out for a piece (its ids,
its number of tokens) serves every text that holds the piece: a word is one piece, whatever
punctuation ends it.  Texts are cut some megabytes at a time by Arrow, which also numbers the distinct
pieces; each of them is looked up once a window in a memo of bounded size.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text that are cut together.
WINDOW = 2 << 20
#: Pieces that a worker remembers, and bytes of them and their values; beyond either it forgets
#: all but the half that most windows used, of which older ones count less.
MEMO_PIECES = 300_000
MEMO_BYTES = 24 << 20
#: Bytes of a remembered piece besides its text and values: its offset, hash, place and numbers.
PIECE_BYTES = 48
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters and digits that are so in every version of Unicode.
_LETTERS = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: Begins a piece with no space before it: the punctuation that ends a word.  Texts that hold it are
#: worked out with care.
_MARK = "\x01"


def _endings(specials: Iterable[str]) -> str:
    """Matches punctuation between a letter or digit and white space, never from within a special
    string, which the pre-tokenizer does not see."""
    inside = "".join(re.findall(f"(?<=[{_LETTERS}])[^{_LETTERS}]", "\n".join(specials)))
    marks = "".join(re.escape(mark) for mark in string.punctuation if mark not in inside)
    return f"([{_LETTERS}])([{marks}]+)([ \n])"


def _may_join(pieces: list[str]) -> list[bool]:
    """Whether each piece after a space, or begun by a newline, may be worked out by itself.

    None of ``pieces`` is empty.
    """
    return [p.strip() == (p if p[0] != "\n" else p[1:] or None) for p in pieces]


class PieceTable:
    """Values of texts from the values of their pieces; a value is an array of 32-bit numbers.

    ``wholes(texts)`` works texts out in full, ``join(values)`` puts values of parts together, and
    ``many(texts)`` gives the values of pieces with their space or newline before them, as one
    array and the length of each.  ``specials`` are strings that are taken out of a text before the
    pre-tokenizer gets it.  ``memo`` times the bounds above are remembered.  The memo is in
    columns: a piece's number is found by its hash, among sorted ones, and its text is compared.
    """

    def __init__(
        self,
        wholes: Callable,
        join: Callable,
        many: Callable | None = None,
        memo: int = 1,
        specials: Iterable[str] = (),
    ):
        self._endings = _endings(specials)
        self._wholes, self._join, self._many = wholes, join, many or self._one_by_one
        self._blank = join([])
        # The empty piece is always known and stands for nothing.
        self._keys, self._memo = pa.array([""], pa.string()), memo
        self._hashes, self._numbers = np.array([hash("")]), np.zeros(1, dtype=np.int64)
        self._octets = PIECE_BYTES
        self._flat, self._starts = self._blank, np.zeros(1, dtype=np.int64)
        self._sizes = np.array([len(self._blank)], dtype=np.int64)
        self._unsafe, self._used = np.ones(1, dtype=bool), np.zeros(1)

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        values = self._wholes(texts)
        return np.concatenate([self._blank[:0], *values]), np.array(list(map(len, values)), dtype=np.int64)

    def _forget(self) -> None:
        """Keep the pieces used most, at most half of either bound."""
        cost = pc.binary_length(self._keys).to_numpy() + PIECE_BYTES + 4 * self._sizes
        order = np.argsort(-self._used[1:], kind="stable") + 1
        order = order[np.cumsum(cost[order]) <= self._memo * MEMO_BYTES // 2][: self._memo * MEMO_PIECES // 2]
        kept = np.concatenate(([0], np.sort(order)))
        sizes = self._sizes[kept]
        ends = np.cumsum(sizes)
        inside = np.repeat(self._starts[kept] - (ends - sizes), sizes)
        self._flat = self._flat[inside + np.arange(len(inside))]
        self._keys = self._keys.take(pa.array(kept))
        number = np.full(len(cost), -1)
        number[kept] = np.arange(len(kept))
        stays = number[self._numbers] >= 0
        self._hashes, self._numbers = self._hashes[stays], number[self._numbers[stays]]
        self._octets = int(cost[kept].sum())
        self._starts, self._sizes = ends - sizes, sizes
        self._unsafe, self._used = self._unsafe[kept], self._used[kept] / 2

    def _learn(self, pieces: list[str], hashes: np.ndarray) -> None:
        joins = _may_join(pieces)
        safe = np.array(joins, dtype=bool)
        ends = np.fromiter((p[0] == _MARK for p in pieces), dtype=bool, count=len(pieces))
        texts = [p if p[0] == "\n" else " " + p for p, ok in zip(pieces, joins) if ok and p[0] != _MARK]
        flat, lengths = self._many(texts)
        starts, sizes = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), len(self._blank))
        sizes[safe & ~ends] = lengths
        starts[safe & ~ends] = len(self._flat) + np.cumsum(lengths) - lengths
        if (ends & safe).any():
            values = self._wholes([pieces[i][1:] for i in np.flatnonzero(ends & safe).tolist()])
            lengths = np.array(list(map(len, values)), dtype=np.int64)
            sizes[ends & safe] = lengths
            starts[ends & safe] = len(self._flat) + len(flat) + np.cumsum(lengths) - lengths
            flat = np.concatenate((flat, *values))
        order = np.argsort(hashes)
        into = np.searchsorted(self._hashes, hashes[order])
        self._hashes = np.insert(self._hashes, into, hashes[order])
        self._numbers = np.insert(self._numbers, into, order + len(self._keys))
        keys = pa.array(pieces, pa.string())
        self._keys = pa.concat_arrays([self._keys, keys])
        self._octets += pc.sum(pc.binary_length(keys)).as_py() + PIECE_BYTES * len(pieces) + 4 * int(sizes.sum())
        self._flat = np.concatenate((self._flat, flat))
        self._starts = np.concatenate((self._starts, starts))
        self._sizes = np.concatenate((self._sizes, sizes))
        self._unsafe = np.concatenate((self._unsafe, ~safe))
        self._used = np.concatenate((self._used, np.zeros(len(pieces))))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the memo holds each of these distinct pieces; those not known are worked out."""
        if len(self._keys) > self._memo * MEMO_PIECES or self._octets > self._memo * MEMO_BYTES:
            self._forget()
        texts = pieces.to_numpy(zero_copy_only=False).tolist()
        hashes = np.fromiter(map(hash, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(hashes)
        found = np.searchsorted(self._hashes, hashes[order])
        places = np.empty(len(texts), dtype=np.int64)
        places[order] = self._numbers[np.minimum(found, len(self._numbers) - 1)]
        # Of two pieces with one hash only the first is found; the other is worked out each time.
        known = pc.equal(self._keys.take(pa.array(places)), pieces).to_numpy(zero_copy_only=False)
        unknown = np.flatnonzero(~known)
        if len(unknown):
            places[unknown] = np.arange(len(unknown)) + len(self._keys)
            self._learn([texts[i] for i in unknown.tolist()], hashes[unknown])
        self._used[places] += 1
        return places

    def careful(self, text: str, goes_on: bool = False):
        """Of a text with white space of any kind, cut only where that is safe."""
        first, *rest = _CUT.split(text)
        parts = [" " + first if goes_on else first, *(" " + piece for piece in rest)]
        return self._join(self._wholes(parts))

    def window(self, texts: list[str], goes_on: list[bool]) -> tuple[np.ndarray, ...]:
        """(values, start and size of each distinct one, their number for every piece, first piece
        of every text, and an end).

        ``goes_on`` marks texts that continue after a space.
        """
        plain = pa.array(texts, pa.string())
        marked = pc.match_substring(plain, _MARK).to_pylist()
        ended = pc.replace_substring_regex(plain, self._endings, rf"\1 {_MARK}\2\3")
        cut = pc.split_pattern(pc.replace_substring(ended, "\n", " \n"), " ")
        begins = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.dictionary_encode()
        number = self._places(coded.dictionary)[coded.indices.to_numpy()]
        touched = np.concatenate(([0], np.cumsum(self._unsafe[number])))
        # The first piece of a text has no space before it, so it is worked out by itself.
        own_head = touched[begins[:-1] + 1] - touched[begins[:-1]]
        bad_rest = (touched[begins[1:]] - touched[begins[:-1]] - own_head) > 0
        heads = coded.dictionary.take(coded.indices.take(pa.array(begins[:-1]))).to_pylist()
        alone, hard = [], []
        for i, head in enumerate(heads):
            if marked[i] or bad_rest[i] or head[:1] == "\n" or (own_head[i] if goes_on[i] else head[-1:].isspace()):
                hard.append(i)
            elif not goes_on[i]:
                alone.append(i)
        for i in hard:
            number[begins[i] : begins[i + 1]] = 0
        extra = self._wholes([heads[i] for i in alone]) if alone else []
        extra += [self.careful(texts[i], goes_on[i]) for i in hard]
        number[begins[[*alone, *hard]]] = len(self._sizes) + np.arange(len(extra))
        lengths = np.array(list(map(len, extra)), dtype=np.int64)
        flat = np.concatenate((self._flat, *extra))
        starts = np.concatenate((self._starts, len(self._flat) + np.cumsum(lengths) - lengths))
        return flat, starts, np.concatenate((self._sizes, lengths)), number, begins


def windows(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """Texts in groups of about ``WINDOW`` characters: (which texts, parts, whether they go on).

    A longer text is cut where that is safe; a part that follows begins after the space.
    """
    which, parts, goes_on, held = [], [], [], 0
    for i, text in enumerate(texts):
        text, later = text or "", False
        while len(text) > WINDOW and (cut := _CUT.search(text, WINDOW)):
            which.append(i)
            parts.append(text[: cut.start()])
            goes_on.append(later)
            yield which, parts, goes_on
            which, parts, goes_on, held = [], [], [], 0
            text, later = text[cut.end() :], True
        which.append(i)
        parts.append(text)
        goes_on.append(later)
        held += len(text)
        if held >= WINDOW:
            yield which, parts, goes_on
            which, parts, goes_on, held = [], [], [], 0
    if parts:
        yield which, parts, goes_on
