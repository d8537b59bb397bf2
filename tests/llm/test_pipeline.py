"""The whole pipeline, stage by stage, against brute force."""

import os
from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import Row
from conftest import near_rows, odd_rows
from test_dedup import brute_components
from test_rest import WORD, by_sql, low
from test_tokens import check_packing, library  # noqa: F401 - a fixture

from pagemill.llm import quality


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute_quality(rows):
    texts, holding = defaultdict(set), defaultdict(lambda: defaultdict(set))

    def plain(line):
        return lowered(" ".join(WORD.findall(line)))

    for _, text, _, source, _ in rows:
        text = text or ""
        texts[source].add(text)
        for line in text.split("\n"):
            if plain(line):
                holding[source][plain(line)].add(text)
    furniture = {
        (source, line)
        for source, lines in holding.items()
        for line, found in lines.items()
        if len(found) > quality.LINE_FLOOR and len(found) > quality.LINE_SHARE * len(texts[source])
    }
    out = []
    for doc_id, text, lang, source, n_chars in rows:
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
        if len(words) < 20 or 100 * len(repeated) > 30 * len(words):
            continue
        lines = [line for line in text.split("\n") if (source, plain(line)) not in furniture]
        rest = "\n".join(lines)
        if len(WORD.findall(rest)) >= 20:
            out.append((doc_id, rest, lang, source, n_chars if rest == text else len(rest)))
    return out


def brute_exact(rows):
    best = {}
    for row in rows:
        if row[1] not in best or low(row[0]) > low(best[row[1]][0]):
            best[row[1]] = row
    return list(best.values())


def brute_near(rows):
    lowest = {doc_id: component for doc_id, _, component in brute_components(rows)}
    return [row for row in rows if lowest[row[0]] == row[0]]


def brute_mix(rows):
    taken = defaultdict(list)
    for found in by_sql("op2_fair_queueing_mix", rows):
        taken[found["doc_id"], found["size"]].append(int(found["taken"] / found["size"] + 0.5) if found["size"] else 0)
    out = []
    for row in rows:
        out += [row] * taken[row[0], len(WORD.findall(row[1] or ""))].pop()
    return out


def test_stages_against_brute_force(spark, make, tmp_path, library):  # noqa: F811
    menu = "Home News About us Contact and all the rest of it"
    pages = [(5_000 + i, f"{menu}\n{text}", "en", "menu", 0) for i, (_, text, *_) in enumerate(near_rows(4, 6, seed=8))]
    rows = [r for r in odd_rows() if r[0] is not None] + near_rows() + pages + near_rows()[:5]
    folder = str(tmp_path / "sf")
    os.makedirs(folder)
    make(rows).write.parquet(f"{folder}/documents.parquet")
    columns = make(rows).columns
    docs, stages = corpus_pipeline.documents(spark, folder), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "ngram_jaccard", "source_mix", "best_fit_packing"]
    expected = rows
    for name, brute in (("quality_rules", brute_quality), ("exact_dedup", brute_exact), ("ngram_jaccard", brute_near),
                        ("source_mix", brute_mix)):
        before, expected = len(expected), brute(expected)
        out = stages[name](spark, docs, folder)
        assert out.columns == columns, name
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        got = sorted((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect())
        assert got == sorted(expected), name
        assert len(expected) != before, "the stage's decisions take effect"
    whole = corpus_pipeline.run(spark, folder).collect()
    check_packing([Row(doc_id=r[0], text=r[1]) for r in expected], whole, library)


def test_a_table_without_rows(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_keep_good_runs_its_measure_once(odd):
    plan = quality.keep_good(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
