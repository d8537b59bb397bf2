import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import toxicity
from pagemill.llm.textbatch import text_windows
from pagemill.llm.toxicity import NEIGHBOURS, Index, _counts, _keys, score_toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(count=1_200, seed=1):
    """(documents, labels): toxic texts hold insults, or a stem under many endings."""
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(count):
        bad = rng.random() < 0.2
        text = rng.choices(pool, k=rng.randint(20, 150))
        for _ in range(rng.randint(2, 5) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Grumpf", "zworx"]) if i % 2 else f"quazzy{rng.choice(pool)}")
        docs.append((i, " ".join(text), "en", "a", 0))
        if rng.random() < 0.7:
            labels.append((i, 1, int(bad)))
    truth = {i: any(s in t.lower() for s in ("grumpf", "zworx", "quazzy")) for i, t, *_ in docs}
    return docs, labels, truth


def test_held_out_accuracy_and_columns(spark, make):
    docs, labels, truth = corpus()
    table = spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("x"))
    rows = score_toxicity(make(docs), table).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0.0 <= row.score <= 1.0 and row.predicted == int(row.score >= 0.5)
        assert len(row.neighbours) == len(row.cosines) <= NEIGHBOURS
        assert row.cosines == sorted(row.cosines, reverse=True)
    held = [r for r in rows if r.held_out]
    caught = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    assert sum(caught) >= 0.95 * len(caught) and sum(clean) <= 0.02 * len(clean)


def test_held_out_labels_play_no_part(spark, make):
    docs, labels, _ = corpus(400)
    turned = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    one, two = (
        sorted((r.doc_id, r.score) for r in score_toxicity(make(docs), spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, turned)
    )
    assert one == two


def made_index(rng, count=700, vocabulary=40):
    example, key, times = [], [], []
    for i in range(count):
        own = rng.sample(range(vocabulary), rng.randrange(0, 6))
        example += [i] * len(own)
        key += own
        times += [rng.randrange(1, 5) for _ in own]
    toxic = np.array([int(any(k < 8 for e, k in zip(example, key) if e == i)) for i in range(count)])
    arrays = np.array(example, dtype=np.int64), np.array(key, dtype=np.uint64), np.array(times, dtype=np.int64)
    return Index(np.arange(1_000, 1_000 + count), toxic, *arrays), arrays


def test_neighbours_against_every_cosine():
    rng = random.Random(2)
    index, (example, key, times) = made_index(rng)
    count = len(index.ids)
    held = np.bincount(np.searchsorted(index.keys, key), minlength=len(index.keys))
    idf = 1 + np.log((1 + count) / (1 + held))
    dense = np.zeros((count, len(index.keys)))
    dense[example, np.searchsorted(index.keys, key)] = (1 + np.log(times)) * idf[np.searchsorted(index.keys, key)]
    norms = np.sqrt((dense**2).sum(axis=1, keepdims=True))
    dense = np.divide(dense, norms, out=dense, where=norms > 0)
    for _ in range(200):
        own = np.sort(np.array(rng.sample(range(len(index.keys)), rng.randrange(1, 7))))
        tf = np.array([rng.randrange(1, 5) for _ in own])
        vector = np.zeros(len(index.keys))
        vector[own] = (1 + np.log(tf)) * idf[own]
        vector /= np.sqrt((vector**2).sum())
        cosines = np.round(np.minimum(dense @ vector, 1.0), 9)
        want = sorted((-c, 1_000 + i) for i, c in enumerate(cosines) if c > 0)[:NEIGHBOURS]
        found, near = index.nearest(*index.vector(index.keys[own], tf))
        assert index.ids[found].tolist() == [i for _, i in want]
        assert np.allclose(near, [-c for c, _ in want])


def test_blocks_are_left_unread(monkeypatch):
    index, _ = made_index(random.Random(3), 4_000)
    read, plain = [], toxicity.ranges
    monkeypatch.setattr(toxicity, "ranges", lambda a, b: (read.append(int(np.sum(b))), plain(a, b))[1])
    spared = 0
    for own in ([1, 9, 20], [2, 5], [30, 31, 32, 33], [0, 39]):
        read.clear()
        index.nearest(*index.vector(index.keys[own], np.array([4] + [1] * (len(own) - 1))))
        postings = sum(int((index._count[index._cells[f] : index._cells[f + 1]]).sum()) for f in own)
        spared += postings - sum(read[1:])
        assert sum(read[1:]) <= postings
    assert spared > 200


def test_calibration_is_monotone_and_between_the_shares():
    index, _ = made_index(random.Random(4), 2_000)
    scores = [index.score(v) for v in (-1.0, 0.0, 0.2, 0.4, 0.6, 0.8, 1.0)]
    assert scores == sorted(scores) and scores[0] < 0.1 and scores[-1] > 0.9


def test_keys_against_plain_python():
    import pyarrow as pa

    texts = ["Hello, wörld! hello", "", None, "abcdef\nabcde x", "ÀB1"]
    ((first, offsets, data),) = text_windows(pa.array(texts))
    text, key, times = _counts(*_keys(offsets, data))
    mark = 1 << 63
    grams = [(int(t), int(k), int(n)) for t, k, n in zip(text, key, times) if not int(k) & mark]
    want = []
    for i, value in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in value or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
        own = [int.from_bytes(w.encode()[j : j + 5], "big") for w in words for j in range(len(w.encode()) - 4)]
        want += [(i, k, own.count(k)) for k in sorted(set(own))]
        assert sum(n for t, k, n in zip(text, key, times) if t == i and int(k) & mark) == len(words)
    assert first == 0 and sorted(grams) == want


def test_odd_texts_labels_and_empty_tables(spark, odd, empty, make):
    docs, labels, _ = corpus(300)
    strange = [(None, 1, 1), (1, None, None), (2, 1, 7), (3, 1, 1), (3, 1, 0), (9, 1, 0), (77_777, 1, 1)]
    table = spark.createDataFrame(labels + strange, LABELS)
    both = make(docs).unionByName(odd)
    rows = score_toxicity(both, table).collect()
    assert len(rows) == both.count()
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    blank = [r for r in rows if r.doc_id is None and not r.neighbours]
    assert blank and all(r.predicted == 0 for r in blank)
    assert score_toxicity(empty, table).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in score_toxicity(both, none).collect()} == {(0.0, 0)}
    same = spark.createDataFrame([(i, 1, 0) for i, *_ in docs], LABELS)
    assert max(r.score for r in score_toxicity(both, same).collect()) < 0.5
