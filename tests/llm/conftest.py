import random

import pytest
from pyspark.sql import functions as F

#: Helper names of the operators, as columns that a caller's table may have too.
CLASHING = (
    "row", "digest", "key", "block", "id", "size", "shard", "token", "doc", "n", "kept", "times", "own", "host",
    "lines", "m", "rest", "chunk", "group", "ticket", "rows", "copy", "taken", "_s", "_source", "spans",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, count, vocabulary=400):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéü"
    pool = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(vocabulary)]
    return [rng.choice(pool) for _ in range(count)]


def odd_rows():
    """Null, empty, blank, repeated, tied, very long and oddly spaced texts; null ids and sources."""
    long_text = " ".join(words(1, 30_000, 5_000))
    base = words(2, 300)
    near = list(base)
    near[10] = "changed"
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (5, "one two", None),
        (6, "One TWO", "b"), (7, " ".join(base), "a"), (8, " ".join(near), "a"), (9, " ".join(base), "b"),
        (9, " ".join(base), "b"), (None, " ".join(base), "c"), (None, None, None), (12, long_text, "c"),
        (13, "  two  spaces   and　odd \n\n ones ", "c"), (14, "a <|endoftext|> b<|endoftext|>", "b"),
        (15, "x" * 50_000, "a"), (16, "word " * 3_000, "a"), (17, "line one\nline one\n\nline two\nline one", "b"),
        (18, "don't we'll I'M 12 345 \U0001f600\U0001f680 naïve ~~~ ===", "b"), (19, "\x1c a \x1f b \x85 c", "a"),
    ]
    return [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]


def near_rows(groups=12, copies=8, seed=5):
    """Groups of near copies by small edits, some just at the bound, and texts that share a passage."""
    rng, out, number = random.Random(seed), [], 1_000
    passage = words("passage", 60)
    for g in range(groups):
        base = words(f"g{g}", rng.randint(20, 260))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                del text[rng.randrange(len(text)) :][: rng.randint(1, 12)]
            out.append((number, " ".join(text), "en", f"s{g % 3}", 0))
            number += 1
    for k in range(20):
        own = words(f"own{k}", rng.randint(30, 120))
        out.append((number, " ".join(passage + own) if k % 2 else " ".join(own[:20] + passage), "en", "s9", 0))
        number += 1
    return out


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, clash=True):
        df = spark.createDataFrame(rows, SCHEMA)
        for name in CLASHING if clash else ():
            df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(odd_rows()).cache()


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def sf(spark):
    """(rows, table) of documents at the smallest scale."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df.collect(), df
