"""Packing, token files and token counts against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import words

from pagemill.llm import huffman, packing, pieces, token_counts
from pagemill.llm.tokens import Encoder, as_ids, encoder, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def packed_ids(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_encoder_equals_library(library, odd, sf):
    texts = [row.text for row in [*odd.collect(), *sf[0][:60]]]
    texts += ["\na b", "a\nb", "a.\nB c.\n", "a \nb", "a\n b", "x\n\ny", " a", "a ", "\n", "the.\r\nEnd, ok. ǅ. 1. a1."]
    got = list(encoder(tokenizer_path()).batch(texts))
    assert [as_ids(raw).tolist() for raw in got] == [library(text) for text in texts]


def test_long_texts_are_cut_in_windows(library, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 50)
    texts = [" ".join(words(k, 40 * k)) + "\n  tail" for k in range(6)] + [None, "", "y" * 200, "a\n b " * 60]
    got = list(encoder(tokenizer_path()).batch(texts))
    assert [as_ids(raw).tolist() for raw in got] == [library(text) for text in texts]
    counts = token_counts.Counter(tokenizer_path()).batch(texts)
    assert counts.tolist() == [len(library(text)) for text in texts]


@pytest.mark.parametrize("bound", [("MEMO_PIECES", 12), ("MEMO_BYTES", 300)])
def test_forgotten_pieces_are_worked_out_again(library, monkeypatch, bound):
    monkeypatch.setattr(pieces, "WINDOW", 60)
    monkeypatch.setattr(pieces, *bound)
    fresh, counter = Encoder(tokenizer_path()), token_counts.Counter(tokenizer_path())
    texts = [" ".join(words(k % 9, 30)) + "\nnext  line\t." for k in range(40)] + ["z" * 500 + " a b"] * 2
    want = [library(text) for text in texts]
    assert [as_ids(raw).tolist() for raw in fresh.batch(texts)] == want
    assert counter.batch(texts).tolist() == [len(ids) for ids in want]
    fresh._table._forget()
    assert len(fresh._table._keys) <= 1 + pieces.MEMO_PIECES // 2
    assert fresh._table._keys.nbytes <= pieces.MEMO_BYTES + 64


def test_memo_is_bounded_and_right():
    from pagemill.llm.common import Memo

    memo = Memo(lambda key: key * 2, 10)
    assert [memo[i % 37] for i in range(500)] == [2 * (i % 37) for i in range(500)]
    assert len(memo) <= 10 and len(memo._old) <= 10


def test_counts_equal_library(library, odd, sf):
    for rows, table in ((odd.collect(), odd), sf):
        want = sorted(
            (r.doc_id or -1, len((r.text or "").encode()), len(library(r.text)), len(library(r.text)) > 512)
            for r in rows
        )
        got = token_counts.count_tokens(table).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_no_rows(empty, spark):
    assert token_counts.count_tokens(empty).collect() == []
    assert packing.pack(empty).collect() == []
    assert huffman.round_trip(empty).collect() == []


def check_packing(rows, got, library, capacity=2048):
    want = []
    for r in rows:
        ids = [*library(r.text), 0]
        start, length, piece = 0, len(ids) % capacity or capacity, 0
        while start < len(ids):
            crc = zlib.crc32(packed_ids(ids[start : start + length]))
            want.append((r.doc_id or -1, piece, start, length, crc))
            start, length, piece = start + length, capacity, piece + 1
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_packing(library, odd, sf):
    for rows, table in ((odd.collect(), odd), sf):
        used, least = check_packing(rows, packing.pack(table).collect(), library)
        assert used <= least + 1
    used, least = check_packing(sf[0], packing.pack(sf[1], group_docs=40).collect(), library)
    assert used <= 1.15 * least + 5


def test_swaps_empty_bins():
    # Best fit over falling lengths needs four bins of 10; moves and exchanges reach three.
    lengths = [6, 5, 5, 4, 4, 3, 3]
    bins = [[0, 5], [1, 4], [2, 3], [6]]
    better = packing.swap_search(lengths, [list(b) for b in bins], 10)
    assert len(better) == 3 and sorted(i for b in better for i in b) == list(range(7))
    assert all(sum(lengths[i] for i in b) <= 10 for b in better)


def test_swaps_never_lower_the_squares():
    import random

    for seed in range(30):
        rng = random.Random(seed)
        lengths = [rng.randint(1, 60) for _ in range(80)]
        order = list(range(80))
        rng.shuffle(order)
        bins, room = [], 0
        for i in order:
            if lengths[i] > room:
                bins.append([])
                room = 100
            bins[-1].append(i)
            room -= lengths[i]
        squares = lambda bb: sum(sum(lengths[i] for i in b) ** 2 for b in bb)
        before = squares(bins)
        better = packing.swap_search(lengths, [list(b) for b in bins], 100)
        assert squares(better) >= before and len(better) <= len(bins)
        assert sorted(i for b in better for i in b) == list(range(80))
        assert all(sum(lengths[i] for i in b) <= 100 for b in better)


def test_swaps_go_on_until_no_pair_of_bins_helps():
    import random
    from itertools import combinations

    rng = random.Random(1)
    lengths = [rng.randint(450, 900) for _ in range(1_000)]
    first = packing.best_fit(lengths, 2048)
    better = packing.swap_search(lengths, [list(b) for b in first], 2048)
    assert len(better) <= 0.98 * len(first)
    assert sorted(i for b in better for i in b) == list(range(1_000))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in better)
    small = [rng.randint(20, 60) for _ in range(60)]
    left = packing.swap_search(small, packing.best_fit(small, 100), 100)
    size = lambda items: sum(small[i] for i in items)
    shapes = {(1, 0), (1, 1), (1, 2), (2, 1)}
    for giver in left:
        for taker in left:
            if giver is taker:
                continue
            for given, back in shapes:
                for out in combinations(giver, given):
                    for into in combinations(taker, back):
                        gain = size(out) - size(into)
                        helps = 0 < gain <= 100 - size(taker) and size(taker) + gain > size(giver)
                        assert not helps


def test_code_lengths_are_optimal_and_limited():
    import heapq
    import random

    rng = random.Random(3)
    for n, limit in ((2, 20), (5, 3), (40, 20), (200, 9), (300, 20)):
        counts = np.array([int(rng.paretovariate(0.6)) for _ in range(n)] + [0, 0])
        lengths = huffman.code_lengths(counts, limit)
        assert lengths[-2:].tolist() == [0, 0] and lengths.max() <= limit
        assert sum(2.0 ** -int(x) for x in lengths if x) == 1
        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        if limit == 20:
            assert int((counts * lengths).sum()) == cost
        assert int((counts * lengths).sum()) >= cost
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


def test_code_round_trip():
    rng = np.random.default_rng(1)
    ids = (rng.pareto(0.5, 5_000) * 3).astype(np.int64) % 3_000
    lengths = huffman.code_lengths(np.bincount(ids, minlength=3_000))
    bits, offsets = huffman.encode(ids, huffman.canonical_codes(lengths), lengths)
    counts = np.full(len(offsets), huffman.STRIDE)
    counts[-1] = len(ids) - huffman.STRIDE * (len(offsets) - 1)
    assert huffman.decode(bits, offsets, counts, huffman.decoding_table(lengths)).tolist() == ids.tolist()
    # Any stretch is decoded by itself from its offset.
    one = huffman.decode(bits, offsets[7:8], counts[7:8], huffman.decoding_table(lengths))
    assert one.tolist() == ids[7 * huffman.STRIDE : 8 * huffman.STRIDE].tolist()


@pytest.mark.parametrize("part_tokens", [1 << 24, 5_000])
def test_token_files(library, odd, sf, monkeypatch, part_tokens):
    monkeypatch.setattr(huffman, "PART_TOKENS", part_tokens)
    for rows, table in ((odd.collect(), odd), sf):
        got = huffman.round_trip(table).orderBy("start").collect()
        ids = [r.doc_id if r.doc_id is not None else -1 for r in got]
        assert ids == sorted(ids)
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
        want = sorted(
            (r.doc_id if r.doc_id is not None else -1, len(t), zlib.crc32(packed_ids(t)))
            for r in rows
            for t in [[*library(r.text), 0]]
        )
        have = [(r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got]
        assert sorted(have) == want


def test_pieces_of_most_windows_are_remembered(monkeypatch):
    """A word of many texts stays known when more new words than the memo holds come after it."""
    monkeypatch.setattr(pieces, "MEMO_PIECES", 200)
    fresh = Encoder(tokenizer_path())
    asked = []
    work_out = fresh._table._many
    monkeypatch.setattr(fresh._table, "_many", lambda texts: asked.extend(texts) or work_out(texts))
    for _ in range(10):
        list(fresh.batch(["one often seen word"]))
    for k in range(3):
        list(fresh.batch([" ".join(f"new{k}y{i}" for i in range(150))]))
    list(fresh.batch(["one often seen word"]))
    assert asked.count(" often") == 1


def test_words_are_worked_out_without_their_punctuation(library, monkeypatch):
    """A word is encoded once, whatever punctuation ends it; so is the punctuation."""
    fresh = Encoder(tokenizer_path())
    asked, apart = [], []
    work_out, alone = fresh._table._many, fresh._table._wholes
    monkeypatch.setattr(fresh._table, "_many", lambda texts: asked.extend(texts) or work_out(texts))
    monkeypatch.setattr(fresh._table, "_wholes", lambda texts: apart.extend(texts) or alone(texts))
    text = "So verlich, verlich. verlich!\nverlich %%% verlich*** verlich, and été. été; 9, end."
    assert [as_ids(raw).tolist() for raw in fresh.batch([text, "\n".join([text] * 3)])] == [library(text), library("\n".join([text] * 3))]
    assert sorted(p for p in asked if "verl" in p) == ["\nverlich", " verlich"]
    assert asked.count(" été") == 1 and apart.count(",") == 1 and apart.count(".") == 1


def test_endings_equal_library(library):
    """Punctuation is cut off only where the library's pattern cuts too."""
    texts = [
        "café, so", "a ́. b", "x\x01, y", "\x01. a", "a\x01.\nb", "it's. it'S, o'. o', 's. x", "a , b .\nc", "2×, 3÷. 4",
        "say <|endoftext|> now", "say<|endoftext|>, now", "say <|endoftext|, now. <|endoftext|>.\n<|endoftext|> ,", "a|. b> c",
        "中文, слово. ², ª. º;", "a.b, c,\td.\r\ne.  f. ", "a.\n\nb,\n", ", a", "a,",
    ]
    got = list(Encoder(tokenizer_path()).batch(texts))
    assert [as_ids(raw).tolist() for raw in got] == [library(text) for text in texts]
    counts = token_counts.Counter(tokenizer_path()).batch(texts)
    assert counts.tolist() == [len(library(text)) for text in texts]


@pytest.mark.parametrize("bound", [1_000_000, 40])
def test_pieces_of_one_hash_are_told_apart(library, monkeypatch, bound):
    monkeypatch.setattr(pieces, "hash", lambda text: len(text) % 3, raising=False)
    monkeypatch.setattr(pieces, "MEMO_PIECES", bound)
    fresh = Encoder(tokenizer_path())
    texts = [" ".join(words(k % 5, 20)) + ".\nnext, line." for k in range(12)]
    for _ in range(2):
        assert [as_ids(raw).tolist() for raw in fresh.batch(texts)] == [library(text) for text in texts]


def test_a_remembered_piece_is_not_a_python_object():
    """Beside its text a piece costs its numbers only, so the memo's bytes hold every piece it may have."""
    fresh = Encoder(tokenizer_path())
    list(fresh.batch([" ".join(f"w{i}" for i in range(5_000))]))
    table = fresh._table
    parts = [table._keys, table._hashes, table._numbers, table._starts, table._sizes, table._used, table._unsafe]
    held = sum(part.nbytes for part in parts) + table._flat.nbytes
    assert held <= 1.01 * table._octets and table._octets / len(table._keys) * pieces.MEMO_PIECES <= pieces.MEMO_BYTES
