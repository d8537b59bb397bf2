"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed; per host the distinct
texts that hold a line are counted.  A line in more than ``LINE_SHARE`` of the host's texts, and
in more than ``LINE_FLOOR`` of them, is furniture of the host and removed.  A document that has
too few words left is depleted and rejected, as is one that fails the base rules.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import (
    _SPACE, boxed, cut_lineage, distinct_sorted, mix, narrow_side, rows_of, window_hashes, word_hashes, word_spans,
)

#: A line above this share of a host's distinct texts is removed ...
LINE_SHARE = 0.05
#: ... if more than so many texts hold it, as a share says nothing about a small host.
LINE_FLOOR = 10
#: Fewer words than this fail the base rules, and are too few to be left of a document.
MIN_WORDS = 20
#: Percentage of words in repeated windows above which the base rules fail.
MAX_REPEAT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_U64 = np.uint64
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_STEP, _BACK = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line number, hash, words) of the lines that have words.

    The hash is taken over the words' hashes, so white space and A-Z case play no part.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    starts, _ = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, _U64), np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    count = np.diff(np.append(first, len(starts)))
    place = np.arange(len(starts)) - np.repeat(first, count)
    steps = np.full(int(count.max()), _STEP, dtype=_U64)
    steps[0] = 1
    weighted = word_hashes(text, fold=True) * np.cumprod(steps)[place]
    return line[first], mix(np.add.reduceat(weighted, first) + count.astype(_U64)), count


def _lines(batches):
    """(source, line, text) per distinct line of a text, and one row without a line per text."""
    for batch in batches:
        names, lines, texts = [], [], []

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(lines, pa.int64()), pa.array(texts, pa.int64())],
                names=["source", "line", "text"],
            )

        for source, text in rows_of([batch], "source", "text"):
            raw = (text or "").encode()
            hashes = distinct_sorted(line_hashes(raw)[1]).view(np.int64)
            words = word_hashes(raw)
            order = np.arange(1, len(words) + 1, dtype=_U64)
            own = int(mix((mix(words) * mix(order)).sum(dtype=_U64, keepdims=True)).view(np.int64)[0])
            names += [source] * (len(hashes) + 1)
            lines += [None, *hashes.tolist()]
            texts += [own] * (len(hashes) + 1)
            if len(names) > 1 << 16:
                yield packed()
                names, lines, texts = [], [], []
        yield packed()


def furniture(
    docs: DataFrame,
    source_column: str = "source",
    text_column: str = "text",
    share: float = LINE_SHARE,
    floor: int = LINE_FLOOR,
) -> DataFrame:
    """(``host``, ``lines``): hashes of the lines to remove of each host that has any.

    Distinct texts are counted, so copies of one text do not condemn its lines.  At most
    ``average lines per text / share`` lines of a host can exceed the share.
    """
    rows = docs.select(F.col(source_column).alias("source"), F.col(text_column).alias("text"))
    lines = rows.mapInArrow(_lines, "source string, line long, text long")
    counts = cut_lineage(
        lines.distinct().groupBy("source", "line").agg(F.count("*").alias("texts")).where(
            F.col("line").isNull() | (F.col("texts") > floor)
        )
    )
    whole = counts.where("line is null").select(F.col("source").alias("host"), F.col("texts").alias("all"))
    frequent = counts.where("line is not null").join(
        F.broadcast(whole) if whole.count() < 100_000 else whole,
        F.col("source").eqNullSafe(F.col("host")) & (F.col("texts") > F.col("all") * share),
    )
    return cut_lineage(frequent.groupBy("host").agg(F.collect_list("line").alias("lines")))


def _measured(text: str | None, removed) -> tuple:
    raw = (text or "").encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    words = word_hashes(raw)
    n_words = len(words)
    points = int(np.count_nonzero((data & 0xC0) != 0x80)) - int(np.count_nonzero(_SPACE[data]))
    seen, doubled = set(), 0
    for piece in (text or "").split("\n"):
        if piece.strip(" \t\n\x0b\x0c\r"):
            doubled += piece in seen
            seen.add(piece)
    repeated = 0
    windows = window_hashes(words, WINDOW)
    if len(windows) > 1:
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[inverse] > 1)
        if len(again):
            cover = np.zeros(n_words + 1, dtype=np.int64)
            np.add.at(cover, again, 1)
            np.add.at(cover, again + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(cover)[:-1]))
    failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEAT * n_words
    left, rest = n_words, None
    if removed is not None and len(removed) and n_words:
        line, hashes, count = line_hashes(raw)
        gone = np.isin(hashes.view(np.int64), np.asarray(removed, dtype=np.int64))
        if gone.any():
            left -= int(count[gone].sum())
            drop = set(line[gone].tolist())
            rest = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
    kept = not failed and left >= MIN_WORDS
    symbols = int(np.count_nonzero(_IS_SYMBOL[data]))
    return n_words, points, symbols, doubled, repeated, failed, kept, left, rest


#: ``rest`` is the text without the removed lines, or NULL if it lost none.
_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_left long, rest string"
)
_NAMES = [part.split()[0] for part in _MEASURES.split(", ")]


def _measure(text: pd.Series, removed: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_measured(*pair) for pair in zip(text, removed)], columns=_NAMES)


def _measure_only(text: pd.Series, removed: pd.Series) -> pd.DataFrame:
    return _measure(text, removed).drop(columns=["rest"])


def _with_measures(docs, source_column, text_column, share, floor, rest=True) -> DataFrame:
    """(``doc``, ``m``): every row of ``docs`` with its measures, and with what is left of its text.

    The function is called nondeterministic so that a filter and a projection over its result do
    not each run it.
    """
    lines = furniture(docs, source_column, text_column, share, floor)
    # A host's list is a few hundred longs at most: see furniture.
    joined = boxed(docs).join(
        narrow_side(lines, 4096), F.col("doc")[source_column].eqNullSafe(F.col("host")), "left"
    )
    if rest:
        measure = F.pandas_udf(_measure, _MEASURES).asNondeterministic()
    else:
        measure = F.pandas_udf(_measure_only, _MEASURES.removesuffix(", rest string")).asNondeterministic()
    return joined.select("doc", measure(F.col("doc")[text_column], F.col("lines")).alias("m"))


def rate(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    share: float = LINE_SHARE,
    floor: int = LINE_FLOOR,
) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``kept`` and ``n_left`` of every document.

    A null text has no words and fails; a null source is a host of its own; rows that repeat
    an id are rated each; an empty table gives an empty result; other columns are ignored.
    """
    plain = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.col(text_column).alias("text")
    )
    rated = _with_measures(plain, "source", "text", share, floor, rest=False)
    return rated.select("doc.doc_id", "m.*")


def keep_good(
    docs: DataFrame,
    source_column: str = "source",
    text_column: str = "text",
    share: float = LINE_SHARE,
    floor: int = LINE_FLOOR,
) -> DataFrame:
    """``docs`` without rejected documents and without the removed lines of the others.

    A column ``n_chars`` follows the text.  Other columns stay as they are, whatever their names;
    a null text is rejected, repeated rows are each judged, a null source is a host of its own, and
    an empty table gives an empty result.
    """
    rated = _with_measures(docs, source_column, text_column, share, floor).where("m.kept")
    rest = F.coalesce("m.rest", F.col("doc")[text_column])
    fields = {name: F.col("doc")[name] for name in docs.columns} | {text_column: rest}
    if "n_chars" in fields:
        length = F.char_length("m.rest").cast(dict(docs.dtypes)["n_chars"])
        fields["n_chars"] = F.coalesce(length, fields["n_chars"])
    return rated.select(*(field.alias(name) for name, field in fields.items()))
