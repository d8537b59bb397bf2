"""A term index over a text column, and ranked search in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import cut_lineage, finished_numbers, remove_folder
from pagemill.sources.tables import KeyedTable


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda term: term != "")


def text_postings(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``term, <key>, tf``; counts are combined within a document before the shuffle."""
    return (
        df.select(key, F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term", key)
        .agg(F.count("*").alias("tf"))
    )


def write_postings(postings: DataFrame, path: str) -> None:
    """Store postings in files sorted by term, so that a lookup reads few row groups.

    A term is in one file, or in several if adaptive execution cuts a frequent one.
    """
    (
        postings.hint("rebalance", "term")
        .sortWithinPartitions("term")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def wanted_terms(query: str | Sequence[str]) -> list[str]:
    words = [query] if isinstance(query, str) else list(query)
    return sorted({word.lower() for word in words})


def term_search(
    postings: DataFrame,
    query: str | Sequence[str],
    documents: DataFrame,
    key: str,
    top: int | None = None,
) -> DataFrame:
    """``<key>, matched, score`` by summed ``tf * ln(N / df)`` over the query's terms.

    Only the postings of those terms are read, once; ``N`` is the number of ``documents``.
    """
    found = cut_lineage(postings.where(F.col("term").isin(wanted_terms(query))).select("term", key, "tf"))
    # One row per query term: bounded by the query.
    frequency = found.groupBy("term").agg(F.count("*").alias("df"))
    total = documents.agg(F.count("*")).scalar()
    scored = found.join(F.broadcast(frequency), "term").groupBy(key).agg(
        F.count("*").alias("matched"),
        F.round(F.sum(F.col("tf") * F.log(F.lit(total) / F.col("df"))), 6).alias("score"),
    )
    return scored if top is None else scored.orderBy(F.desc("score"), key).limit(top)


class TermIndex:
    """A term index at rest that grows batch by batch.

    ``postings/batch_id=N`` holds the postings of one write, sorted by term; ``keys`` is a keyed
    table that names the batch each document was last written in.  Postings of an earlier
    batch are dead and left out at read, so a replaced document needs no rewrite of the terms it
    lost.  ``merged/upto=N`` holds the live postings up to a batch; it is made anew when the
    later ones reach ``MERGE_SHARE`` of it or ``MERGE_BATCHES`` batches.
    """

    MERGE_SHARE = 0.5
    MERGE_BATCHES = 16

    def __init__(self, spark: SparkSession, path: str, key: str, text: str = "text") -> None:
        self.spark, self.path, self.key, self.text = spark, path.rstrip("/"), key, text
        self._keys = KeyedTable(spark, f"{self.path}/keys", key)

    def _folders(self) -> tuple[int | None, list[int]]:
        """The newest merge, and the batches that follow it."""
        merged = finished_numbers(self.spark, self.path, "merged/upto")
        batches = finished_numbers(self.spark, self.path, "postings/batch_id")
        upto = merged[-1] if merged else None
        return upto, [n for n in batches if upto is None or n > upto]

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Index the texts of a batch; a replay of the batch replaces what it wrote."""
        batch = F.lit(batch_id).cast("long").alias("batch")
        postings = text_postings(rows, self.key, self.text).select("term", self.key, "tf", batch)
        write_postings(postings, f"{self.path}/postings/batch_id={batch_id}")
        self._keys.append(rows.select(self.key, batch), batch_id)
        if self._due():
            self.merge()

    def _due(self) -> bool:
        upto, batches = self._folders()
        if upto is None or len(batches) >= self.MERGE_BATCHES:
            return len(batches) >= self.MERGE_BATCHES
        # Rows are counted from file footers.
        later = self._read([f"postings/batch_id={n}" for n in batches]).count() if batches else 0
        return later >= self.MERGE_SHARE * self._read([f"merged/upto={upto}"]).count()

    def _read(self, folders: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/{folders[0]}").schema
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{name}" for name in folders))

    def stored(self) -> DataFrame | None:
        """All postings at rest, with the ``batch`` of each."""
        upto, batches = self._folders()
        folders = ([f"merged/upto={upto}"] if upto is not None else []) + [f"postings/batch_id={n}" for n in batches]
        return self._read(folders) if folders else None

    def live(self, postings: DataFrame) -> DataFrame:
        """Postings of documents that no later batch wrote again."""
        keys = self._keys.current().select(self.key, "batch")
        return postings.join(keys, [self.key, "batch"], "left_semi")

    def postings(self) -> DataFrame:
        return self.live(self.stored()).select("term", self.key, "tf")

    def search(self, query: str | Sequence[str], top: int | None = None) -> DataFrame:
        """As :func:`term_search`, over the stored postings of the query's terms."""
        found = self.stored().where(F.col("term").isin(wanted_terms(query)))
        return term_search(self.live(found), query, self._keys.current(), self.key, top)

    def merge(self) -> None:
        """Store the live postings in one sorted run; what it covers goes, but for the last batch."""
        upto, batches = self._folders()
        if not batches:
            return
        write_postings(self.live(self.stored()).select("term", self.key, "tf", "batch"), f"{self.path}/merged/upto={batches[-1]}")
        # The newest batch may be replayed, and readers may be on the merge before.
        for n in batches[:-1]:
            remove_folder(self.spark, f"{self.path}/postings/batch_id={n}")
        for n in finished_numbers(self.spark, self.path, "merged/upto")[:-2]:
            remove_folder(self.spark, f"{self.path}/merged/upto={n}")
        self._keys.maybe_compact(1)
