import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import fpsearch
from pagemill.llm.fpsearch import Best, Tree, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    texts = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    frequency = Counter(t for _, c in counted for t in c)
    by_item = {}
    for item, text in items:
        by_item.setdefault(item, set()).update(terms(text))
    out = []
    for item, asked in by_item.items():
        ranked = []
        for i, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * texts) // total if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * texts + 2) / (2 * frequency[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in asked
                if t in c
            )
            if score > 0:
                ranked.append((-score, i is None, i or 0))
        ranked.sort()
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(ranked[:top], 1)]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted(map(tuple, rank_documents(docs, items, **options).collect()), key=repr)


def items_table(spark, rows):
    df = spark.createDataFrame(rows, "item_id long, text string")
    return df.withColumn("rank", F.lit("x")).withColumn("part", F.lit(1)).withColumn("score", F.lit(0))


def made(count, seed=4, vocabulary=60):
    rng = random.Random(seed)
    pool = [f"t{k}" for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    rows = [(i, " ".join(rng.choices(pool, weights, k=rng.randrange(1, 60)))) for i in range(count)]
    # Copies by the hundred: one path, equal scores.
    rows += [(count + i, rows[5][1]) for i in range(300)] + rows[:3]
    asked = [(i, " ".join(rng.choices(pool, k=rng.randrange(1, 12)))) for i in range(25)]
    return rows, asked + [(30, rows[5][1]), (31, "unheard of"), (32, ""), (33, None), (2, "t1 T2 t2")]


def test_against_brute_force_in_one_and_many_trees(spark, make, monkeypatch):
    rows, asked = made(1_500)
    docs = make([(i, t, "en", "a", 0) for i, t in rows])
    want = expected(rows, asked)
    assert found(docs, items_table(spark, asked)) == want
    # Small trees are set in the call that ships the function, so the tasks see them too.
    assert found(docs, items_table(spark, asked), top=3) == expected(rows, asked, 3)


def test_items_in_groups(spark, make, monkeypatch):
    rows, asked = made(200)
    docs = make([(i, t, "en", "a", 0) for i, t in rows])
    monkeypatch.setattr(fpsearch, "ITEM_BYTES", 200)
    assert found(docs, items_table(spark, asked)) == expected(rows, asked)


def test_odd_and_empty(spark, odd, empty, make):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(1, "one two WORD"), (2, "don't naïve"), (None, "ones and"), (None, "two"), (3, "x" * 50_000), (4, None)]
    assert found(odd, items_table(spark, asked)) == expected(rows, asked)
    assert found(empty, items_table(spark, asked)) == []
    assert found(odd, items_table(spark, [])) == []
    assert found(make([(1, None, "en", "a", 0), (2, " -", "en", "a", 0)]), items_table(spark, asked)) == []


def test_given_tables(spark, sf):
    rows, table = sf
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = expected([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items.collect()])
    assert found(table, items) == want


def tree_of(rng, count, vocabulary):
    doc, rank, tf = [], [], []
    for i in range(count):
        own = [r for r in range(vocabulary) if rng.random() < 0.7 / (r + 1) + 0.02]
        doc += [i] * len(own)
        rank += own
        tf += [rng.randrange(1, 6) for _ in own]
    m = np.array([rng.randrange(10, 400) for _ in range(count)], dtype=np.int64)
    return np.arange(count), m, *(np.array(x, dtype=np.int64) for x in (doc, rank, tf))


def test_tree_bounds_hold_and_spare_work(monkeypatch):
    rng = random.Random(8)
    ids, m, doc, rank, tf = tree_of(rng, 3_000, 40)
    tree = Tree(ids, m, doc, rank, tf)
    assert sorted(tree.ids.tolist()) == list(range(3_000))
    leaves = [span for span, below in zip(tree._spans, tree._children) if not below]
    assert max(b - a for a, b in leaves) <= fpsearch.BUCKET
    assert sorted(i for a, b in leaves for i in range(a, b)) == list(range(3_000))
    read = []
    offer = Tree._offer
    monkeypatch.setattr(Tree, "_offer", lambda self, a, b, *rest: (read.append(b - a), offer(self, a, b, *rest)))
    by_doc = {}
    for d, r, f in zip(doc.tolist(), rank.tolist(), tf.tolist()):
        by_doc.setdefault(d, {})[r] = f
    for asked in ([0, 5, 30], [39], [20, 21, 22, 23]):
        weight = np.array([100 + 50 * r for r in asked], dtype=np.int64)
        best = Best(10)
        read.clear()
        tree.search(np.array(asked), weight, best)
        scores = {
            d: sum(int(w) * (10**9 * own[r] // (1000 * own[r] + 8 * int(m[d]))) for r, w in zip(asked, weight) if r in own)
            for d, own in by_doc.items()
        }
        want = sorted((-s, d) for d, s in scores.items() if s > 0)[:10]
        assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want
        assert sum(read) < 3_000
