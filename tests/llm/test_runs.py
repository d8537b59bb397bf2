import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.runs import WaveletTree, collapse_runs, run_digests, word_runs


def plain_runs(words):
    """All (start, length, period), straight from the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        start = None
        for j in range(n - q + 1):
            if j < n - q and words[j] == words[j + q]:
                start = j if start is None else start
                continue
            if start is not None:
                run = words[start : j + q]
                smaller = any(all(run[i] == run[i + p] for i in range(len(run) - p)) for p in range(1, q))
                if len(run) >= max(6, 4 * q) and not smaller:
                    out.append((start, len(run), q))
            start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_runs(texts):
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    words = np.array([w for t in texts for w in t], dtype=np.uint64)
    text, *rest = word_runs(words, offsets)
    return [list(zip(*(part[text == i].tolist() for part in rest))) for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_runs_of_few_words(texts):
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_runs_of_every_period_and_length():
    rng = random.Random(3)
    texts = []
    for period in range(1, 30):
        for length in (4 * period - 1, 4 * period, 5 * period + 3, 9 * period):
            core = [(10 + k) for k in range(period)]
            rng.shuffle(core)
            own = [core[i % period] for i in range(length)]
            lead = [rng.randrange(100, 200) for _ in range(rng.randrange(9))]
            texts.append(lead + own + [rng.randrange(300, 400) for _ in range(rng.randrange(9))])
            texts.append((own + lead) * 4)
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_wavelet_tree_successor():
    rng = np.random.default_rng(1)
    for _ in range(50):
        values = rng.integers(0, 64, rng.integers(1, 80))
        tree = WaveletTree(values, 7)
        lo = rng.integers(0, len(values), 40)
        hi = np.array([rng.integers(a, len(values) + 1) for a in lo])
        after = rng.integers(0, 64, 40)
        want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in zip(lo, hi, after)]
        assert tree.successor(lo, hi, after).tolist() == want


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines).hexdigest(), hashlib.sha256(rest).hexdigest(),
    )


def rows_of(df):
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted((tuple(row[name] for name in names) for row in df.collect()), key=repr)


def test_digests_against_brute_force(make):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [f"w{rng.randrange(3 if i % 3 else 90)}" for _ in range(rng.randrange(120))]
        text = rng.choice([" ", "\n", " \t "]).join(words) if i % 17 else None
        rows.append((i if i % 50 else None, text, "en", "a", 0))
    rows += rows[:20]
    got = rows_of(run_digests(make(rows)))
    assert got == sorted((expected(i, t) for i, t, *_ in rows), key=repr)
    assert any(row[1] for row in got)


def test_given_documents_that_repeat(sf):
    rows, table = sf
    short = [(r.doc_id, r.text) for r in rows if len((r.text or "").split()) <= 400]
    ids = {i for i, _ in short}
    got = [row for row in rows_of(run_digests(table)) if row[0] in ids]
    assert got == sorted((expected(*row) for row in short), key=repr)


def test_odd_texts(odd, empty):
    rows = {r.doc_id: r for r in collapse_runs(odd).collect()}
    for i in (1, 2, 3):
        assert (rows[i].n_words, rows[i].runs, rows[i].collapsed) == (0, [], "")
    assert [tuple(r) for r in rows[16].runs] == [(0, 3000, 1)] and rows[16].collapsed == "word"
    assert rows[15].n_words == 1 and rows[12].n_words == 30_000 and rows[12].runs == []
    assert collapse_runs(odd).count() == odd.count()
    assert collapse_runs(empty).count() == run_digests(empty).count() == 0


def test_overlapping_runs_and_neighbours(make):
    text = "a b a b a b a b c c c c c c c a b c a b c a b c a b c"
    rows = collapse_runs(make([(1, text, "en", "a", 0), (2, text, "en", "a", 0)])).collect()
    assert {tuple(map(tuple, r.runs)) for r in rows} == {tuple(plain_runs(text.split()))}
    assert rows[0].collapsed == rows[1].collapsed
