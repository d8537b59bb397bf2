"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import (
    exact, fpsearch, huffman, jaccard, mixing, packing, quality, runs, secrets, sharding, token_counts, toxicity,
    wrappers,
)
from pagemill.llm.common import documents, pages

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_main_text(pages(spark, sf_dir))


def op2_fair_queueing_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("finish")


def op3_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op4_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(documents(spark, sf_dir))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(documents(spark, sf_dir))


def op7_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op8_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def op9_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


def op10_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op11_nearest_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op12_pattern_matching_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(documents(spark, sf_dir))


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fpsearch.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_html_wrappers, op2_fair_queueing_mix, op3_parity_sketch_join, op4_line_frequency_rules,
        op5_swap_packing, op6_huffman_token_files, op7_differencing_shards, op8_heavy_hitter_dedup,
        op9_assignment_secrets, op10_heap_token_counts, op11_nearest_toxicity, op12_pattern_matching_runs,
        op13_fp_tree_search,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    # The pages of these tables hold their main text in one article; the references in it are five.
    "op1_html_wrappers": r"""
with plain as (
  select page_id, url,
         regexp_replace(regexp_replace(
           regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1),
           '</?(?:b|i|em|strong|a|span)(?:\s[^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') as body
  from pages),
decoded as (
  select page_id, url,
         replace(replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&amp;', '&') as body
  from plain),
texts as (select page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) as text from decoded)
select page_id, url, text, length(text)::bigint as n_chars from texts""",
    "op3_parity_sketch_join": rf"""
with recursive docs as (
  select row_number() over () as id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words
  from documents),
shingles as (
  select distinct id, hash(array_to_string(list_slice(words, i, i + 4), ' ')) as s
  from (select id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from docs where len(words) > 0)),
sizes as (select id, count(*) as n from shingles group by id),
pairs as (
  select a.id as u, b.id as v, count(*) as n_both
  from shingles a join shingles b on a.s = b.s and a.id < b.id group by a.id, b.id),
links as (
  select u, v from pairs join sizes x on x.id = u join sizes y on y.id = v
  where 100 * n_both >= 80 * (x.n + y.n - n_both)),
edges as (select u, v from links union all select v, u from links),
reach as (select id, id as root from docs union select r.id, e.v from reach r join edges e on r.root = e.u),
lowest as (select r.id, min(d.doc_id) as component_id from reach r join docs d on d.id = r.root group by r.id)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, l.component_id
from docs d left join sizes s using (id) join lowest l using (id)""",
    "op2_fair_queueing_mix": rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size,
         md5(concat_ws(':', doc_id::varchar, md5(coalesce(text, '')))) as ticket
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select source, source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from totals),
leveled as (
  select *, 3 * source_size as cap,
         row_number() over (order by source_size / weight, source nulls last) as place,
         ((sum(source_size) over ())
           - coalesce(sum(3 * source_size) over (order by source_size / weight, source nulls last
               rows between unbounded preceding and 1 preceding), 0))::double
         / (sum(weight) over (order by source_size / weight, source nulls last
               rows between current row and unbounded following))::double as level
  from weighted),
targets as (
  select source, source_size,
         case when cap <= level * weight then cap::double
              else weight * (select arg_min(level, place) from leveled where cap > level * weight) end as target
  from leveled),
queued as (
  select s.*, t.source_size, t.target,
         (sum(size) over (partition by s.source order by ticket, doc_id, size
            rows unbounded preceding) - size)::bigint as begin_at
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (greatest(0, least(size, round(target)::bigint - begin_at))
      + greatest(0, least(size, round(target)::bigint - begin_at - source_size))
      + greatest(0, least(size, round(target)::bigint - begin_at - 2 * source_size)))::bigint as taken
from queued""",
    "op4_line_frequency_rules": rf"""
with docs as (
  select row_number() over () as id, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as words
  from documents),
lines as (
  select id, source, text, n, line, regexp_extract_all(line, '{_WORD}') as line_words
  from (select id, source, text, unnest(string_split(text, chr(10))) as line,
               generate_subscripts(string_split(text, chr(10)), 1) as n from docs)),
spoken as (
  select id, source, text, n, line, len(line_words) as n_line_words,
         translate(array_to_string(line_words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as plain
  from lines where len(line_words) > 0),
hosts as (select source, count(distinct text) as texts from docs group by source),
frequent as (
  select s.source, s.plain from spoken s join hosts h on s.source is not distinct from h.source
  group by s.source, s.plain, h.texts
  having count(distinct s.text) > 10 and count(distinct s.text) > 0.05::double * h.texts),
per_line as (
  select s.id, count(*) - count(distinct s.line) as n_dup_lines,
         sum(case when f.plain is null then 0 else n_line_words end) as gone
  from spoken s left join frequent f on s.source is not distinct from f.source and s.plain = f.plain
  group by s.id),
grams as (
  select id, i, list_slice(words, i, i + 7) as gram
  from (select id, words, unnest(range(1, len(words) - 6)) as i from docs where len(words) >= 8)),
again as (select id, i from (select id, i, count(*) over (partition by id, gram) as c from grams) where c > 1),
covered as (
  select id, count(distinct i + k) as n_repeat_words
  from again, (select unnest(range(0, 8)) as k) group by id),
measured as (
  select d.doc_id, len(d.words)::bigint as n_words,
         coalesce(length(array_to_string(d.words, '')), 0)::bigint as word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(p.n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(c.n_repeat_words, 0)::bigint as n_repeat_words,
         coalesce(p.gone, 0) as gone
  from docs d left join per_line p using (id) left join covered c using (id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_words - gone >= 20 as kept
from measured""",
    "op8_heavy_hitter_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""",
    "op13_fp_tree_search": rf"""
with docs as (
  select row_number() over () as id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') as terms
  from documents),
sizes as (select id, doc_id, len(terms)::bigint as n from docs where len(terms) > 0),
overall as (select count(*)::bigint as texts, sum(n)::bigint as total from sizes),
counts as (
  select id, term, count(*)::bigint as tf from (select id, unnest(terms) as term from docs) group by id, term),
weights as (
  select term, floor(1000 * ln((2 * texts + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*)::bigint as df from counts group by term), overall),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term
  from benchmark),
measured as (select id, doc_id, 10 + (90 * n * texts) // total as m from sizes, overall),
scored as (
  select a.item_id, d.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked a join weights using (term) join counts c using (term) join measured d using (id)
  group by a.item_id, d.id, d.doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place
  from scored where score > 0)
select item_id, place::int as rank, doc_id, score from ranked where place <= 10""",
}
