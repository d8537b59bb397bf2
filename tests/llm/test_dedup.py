"""Exact dedup, the Jaccard join and components against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import near_rows, odd_rows  # noqa: F401  (tests/llm/conftest.py)

from pagemill.llm import exact, jaccard
from pagemill.llm.components import connected_components

low = -(10**18)


def none_low(value):
    return low if value is None else value


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max(map(none_low, ids))
        kept = False
        for i in ids:
            own = none_low(i) == keep and not kept
            kept = kept or own
            out.append((none_low(i), keep, len(ids), own, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("support", [1e-3, 0.2])
def test_exact_dedup(make, support):
    rows = odd_rows() + [(100 + i, "hot", "en", "a", 3) for i in range(200)] + near_rows(4)
    got = exact.exact_dedup(make(rows), support=support).collect()
    assert sorted((none_low(r[0]), none_low(r[1]), *r[2:]) for r in got) == brute_exact(rows)


def test_drop_copies(make):
    rows = odd_rows() + [(100 + i, "hot", "en", "a", 3) for i in range(50)]
    table = make(rows)
    kept = exact.drop_copies(table)
    assert kept.columns == table.columns
    got = sorted((none_low(r.doc_id), r.text or "") for r in kept.collect())
    assert got == sorted((b[1], t) for t in {r[1] or "" for r in rows} for b in brute_exact(rows)
                         if b[3] and b[4] == hashlib.sha256(t.encode()).hexdigest())


def test_hot_digests_do_not_shuffle(make):
    rows = [(i, "hot" if i % 3 else f"text {i}", "en", "a", 3) for i in range(600)]
    plan = exact.exact_dedup(make(rows))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return sorted((none_low(r[0]), len(s), none_low(least[find(i)])) for i, (r, s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("seed", [5, 6])
def test_near_duplicates(make, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 2)
    rows = odd_rows() + near_rows(seed=seed)
    got = jaccard.near_duplicates(make(rows)).collect()
    assert sorted((none_low(r[0]), r[1], none_low(r[2])) for r in got) == brute_components(rows)


def chains(seed=9):
    """Copies of copies: each alike to the next, the ends not to each other."""
    rng, out = random.Random(seed), []
    text = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for i in range(60):
        out.append((2_000 + i, " ".join(text), "en", "a", 0))
        for k in range(4):
            text[(7 * i + 50 * k) % 200] = f"n{rng.randrange(10**6)}"
    return out


def test_chains_keep_every_link(make):
    rows = chains() + chains(10)[::3]
    rows = [(5_000 + i, *r[1:]) for i, r in enumerate(rows)]
    got = jaccard.near_duplicates(make(rows)).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == brute_components(rows)


def test_keep_one_and_empty(make, empty):
    rows = near_rows(5)
    table = make(rows)
    kept = jaccard.keep_one_of_each(table)
    assert kept.columns == table.columns
    wanted = {r[2] for r in brute_components(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    assert jaccard.near_duplicates(empty).collect() == []
    assert exact.exact_dedup(empty).collect() == [] and exact.drop_copies(empty).collect() == []


def test_rare_cells_meet_the_pigeonhole():
    """Sets at the bound of similarity share a chosen cell, whatever the counters say."""
    rng = np.random.default_rng(2)
    for trial in range(300):
        size = int(rng.integers(1, 400))
        base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = int(rng.integers(0, len(base) // 5 + 1))
        other = base[gone:]
        extra = int(rng.integers(0, max(1, len(base) // 5)))
        other = np.unique(np.concatenate((other, rng.integers(0, 1 << 63, extra, dtype=np.uint64))))
        both = len(np.intersect1d(base, other))
        if not len(other) or 100 * both < 80 * (len(base) + len(other) - both):
            continue
        counters = rng.integers(0, 9, jaccard.COUNTERS)
        shared = set(jaccard._bands_of(len(base))) & set(jaccard._bands_of(len(other)))
        assert any(
            set(jaccard.rarest_cells(base, band, counters).tolist())
            & set(jaccard.rarest_cells(other, band, counters).tolist())
            for band in shared
        ), trial


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for x in parent}
    alone = {a for a, b in pairs if a == b and list(want.values()).count(a) == 1}
    assert got == {x: r for x, r in want.items() if x not in alone}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_ids_that_repeat_with_other_texts(make):
    """A repeated id may stand for several sets, some of which other ids hold too."""
    a, b = near_rows(2, 3, seed=11)[:2], near_rows(2, 3, seed=12)[3:5]
    rows = [(1, *a[0][1:]), (1, *a[0][1:]), (1, *b[0][1:]), (0, *b[0][1:]), (2, *a[1][1:]), (3, *b[1][1:]),
            (None, *a[0][1:]), (None, *a[0][1:])]
    got = jaccard.near_duplicates(make(rows)).collect()
    assert sorted((none_low(r[0]), r[1], none_low(r[2])) for r in got) == brute_components(rows)


def test_unrelated_short_texts_share_no_cell():
    """Random sets of any small size are filed under cells of their own, not under empty ones."""
    rng = np.random.default_rng(8)
    counters = np.ones(jaccard.COUNTERS, dtype=np.int64)
    for size in (4, 5, 6, 8, 12, 20, 40, 64, 100, 200, 400):
        held = defaultdict(int)
        for _ in range(20_000 if size == 12 else 2_000):
            shingles = np.sort(rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
            for token in jaccard.rarest_cells(shingles, jaccard._bands_of(size)[-1], counters).tolist():
                held[token] += 1
        assert max(held.values()) <= 2, size
