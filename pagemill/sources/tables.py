"""Keyed tables at rest: an append-only change log over folded buckets, in plain parquet.

A row belongs to a bucket by a hash of its key (of its canonical form when the key is a URL, so
all spellings of a URL share a bucket).  A table is a folder with

* ``log/batch_id=N/_bucket=B``: the rows of one write, one per key;
* ``base/fold=F/upto=N/_bucket=B``: one row per key of a bucket, folded from everything up to
  batch N.  A fold holds only the buckets it rewrote; of each bucket the newest fold counts;
* ``layout/batch_id=N``: the number of buckets and the schema, written when they change.

A write of the same batch replaces its own folder, so a replay changes nothing, and a write that
did not finish has no ``_SUCCESS`` and is not read.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.urls import canonical_url
from pagemill.operators.keyed import keep_last
from pagemill.operators.schema import conform, merge_schema
from pagemill.session import numbered_paths, remove_folder

#: Buckets of a new table.  One should hold no more than a few GB, so that a fold of it is cheap:
#: a large table is made with more (``ImportOptions.buckets``).
BUCKETS = 16
#: A bucket is folded when its log reaches this share of its rows, so that a row is rewritten
#: a number of times that grows with the logarithm of the table ...
FOLD_SHARE = 0.2
#: ... or when so many batches have touched it, so that a reader opens few files.
FOLD_BATCHES = 32

_BUCKET, _CANONICAL = "_bucket", "_canonical"


class KeyedTable:
    """A table with one current row per key.

    ``partition_by`` splits the folded buckets further by a column of few values;
    ``rows_per_file`` bounds the rows of a file; ``buckets`` counts for a new table only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        partition_by: str | None = None,
        buckets: int = BUCKETS,
        rows_per_file: int | None = None,
    ) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.partition_by, self.rows_per_file = partition_by, rows_per_file
        self._new_buckets = buckets
        self._layouts: dict[int, tuple[int, T.StructType]] = {}

    # --- folders ---------------------------------------------------------------------

    def _named(self, pattern: str) -> list[tuple[int, ...]]:
        return numbered_paths(self.spark, self.path, pattern)

    def batches(self) -> list[int]:
        return [n for (n,) in self._named("log/batch_id=*/_SUCCESS")]

    def _folds(self, before: int | None = None) -> dict[int, list[tuple[int, int]]]:
        """Per bucket its finished folds as (fold, upto), oldest first."""
        finished = {fold for (fold,) in self._named("base/fold=*/_SUCCESS")}
        folds: dict[int, list[tuple[int, int]]] = {}
        for fold, upto, bucket in self._named(f"base/fold=*/upto=*/{_BUCKET}=*"):
            if fold in finished and (before is None or upto < before):
                folds.setdefault(bucket, []).append((fold, upto))
        return folds

    def bases(self) -> list[int]:
        """The batches up to which any bucket is folded."""
        return sorted({upto for folds in self._folds().values() for _, upto in folds})

    def _written(self, before: int | None = None) -> list[tuple[int, int]]:
        """(batch, bucket) of the finished log folders."""
        finished = set(self.batches())
        return [
            (n, bucket)
            for n, bucket in self._named(f"log/batch_id=*/{_BUCKET}=*")
            if n in finished and (before is None or n < before)
        ]

    def next_batch(self) -> int:
        return max([-1, *self.batches(), *self.bases()]) + 1

    # --- layout ----------------------------------------------------------------------

    def _layout(self, before: int | None = None) -> tuple[int, T.StructType] | None:
        """Buckets and schema as of the batches before ``before``."""
        known = [n for (n,) in self._named("layout/batch_id=*/_SUCCESS") if before is None or n < before]
        if not known:
            return None
        if known[-1] not in self._layouts:
            row = self.spark.read.parquet(f"{self.path}/layout/batch_id={known[-1]}").first()
            self._layouts[known[-1]] = row["buckets"], T._parse_datatype_json_string(row["schema"])
        return self._layouts[known[-1]]

    def schema(self, before: int | None = None) -> T.StructType | None:
        """Every column the table ever had, in the order they came."""
        layout = self._layout(before)
        return None if layout is None else layout[1]

    def _ensure(self, rows: T.StructType, batch_id: int) -> tuple[int, T.StructType]:
        """The layout for a write of ``rows``; new columns are added to the table."""
        old = self._layout(before=batch_id)
        buckets = old[0] if old else self._new_buckets
        schema = merge_schema(old[1] if old else None, rows, self.key)
        if old is None or schema != old[1]:
            self._layouts.pop(batch_id, None)
            stored = self.spark.createDataFrame([(buckets, schema.json())], "buckets int, schema string")
            stored.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout/batch_id={batch_id}")
        return buckets, schema

    def _canonical(self, schema: T.StructType) -> bool:
        return self.key == "url" and isinstance(schema["url"].dataType, T.StringType)

    def _bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _bucketed(self, rows: DataFrame, buckets: int, schema: T.StructType) -> DataFrame:
        key = F.col(self.key)
        if self._canonical(schema):
            rows = rows.withColumn(_CANONICAL, F.coalesce(canonical_url(key), key))
            key = F.col(_CANONICAL)
        return rows.withColumn(_BUCKET, self._bucket_of(key, buckets))

    # --- writes ----------------------------------------------------------------------

    def _order(self, schema: T.StructType) -> list[str]:
        canonical = [_CANONICAL] if self._canonical(schema) else []
        return [*canonical, self.key]

    def append(
        self,
        rows: DataFrame,
        batch_id: int | None = None,
        observation: Observation | None = None,
        metrics: dict[str, Column] | None = None,
    ) -> int:
        """Write rows (one per key) as a batch; new columns are added to the table.

        Adaptive execution cuts large buckets and joins small ones, so files have even sizes.
        ``metrics`` are observed on the rows as they are written, in the last stage of the
        write, so a repeated task does not count twice.
        """
        batch_id = self.next_batch() if batch_id is None else batch_id
        buckets, schema = self._ensure(rows.schema, batch_id)
        placed = self._bucketed(conform(rows, schema), buckets, schema)
        placed = placed.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *self._order(schema))
        if observation is not None:
            placed = placed.observe(observation, *(value.alias(name) for name, value in metrics.items()))
        self._save(placed.write.partitionBy(_BUCKET), f"log/batch_id={batch_id}")
        return batch_id

    def _save(self, writer, folder: str) -> None:
        writer = writer.mode("overwrite").option("compression", "zstd")
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        writer.parquet(f"{self.path}/{folder}")

    # --- reads -----------------------------------------------------------------------

    def _stored(self, schema: T.StructType, *extra: T.StructField) -> T.StructType:
        canonical = [T.StructField(_CANONICAL, T.StringType())] if self._canonical(schema) else []
        return T.StructType([*schema.fields, *canonical, T.StructField(_BUCKET, T.IntegerType()), *extra])

    def _read_base(self, schema: T.StructType, newest: dict[int, tuple[int, int]]) -> DataFrame:
        paths = [f"{self.path}/base/fold={f}/upto={n}/{_BUCKET}={b}" for b, (f, n) in sorted(newest.items())]
        reader = self.spark.read.schema(self._stored(schema)).option("basePath", f"{self.path}/base")
        return reader.parquet(*paths)

    def _read_log(self, schema: T.StructType, written: list[tuple[int, int]]) -> DataFrame:
        stored = self._stored(schema, T.StructField("batch_id", T.LongType()))
        paths = [f"{self.path}/log/batch_id={n}/{_BUCKET}={b}" for n, b in written]
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/log").parquet(*paths)

    def _pending(self, before: int | None = None) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int]]]:
        """The newest fold of each bucket, and the log folders that follow it."""
        newest = {bucket: folds[-1] for bucket, folds in self._folds(before).items()}
        written = [(n, b) for n, b in self._written(before) if b not in newest or n > newest[b][1]]
        return newest, written

    def current(
        self,
        before: int | None = None,
        buckets: Collection[int] | None = None,
        keys: DataFrame | None = None,
        hidden: bool = False,
    ) -> DataFrame | None:
        """One row per key as of the batches before ``before`` (all of them by default).

        The base is not regrouped: it loses the keys that the log replaces.  ``buckets`` reads
        those alone, ``keys`` (column ``url``, or that of the key) only rows with these keys, in
        any spelling.  ``hidden`` keeps the columns that place a row.
        """
        layout = self._layout(before)
        if layout is None:
            return None
        schema = layout[1]
        newest, written = self._pending(before)
        if buckets is not None:
            newest = {b: fold for b, fold in newest.items() if b in buckets}
            written = [(n, b) for n, b in written if b in buckets]
        names = self._stored(schema).names if hidden else schema.names
        if not newest and not written:
            return self.spark.createDataFrame([], self._stored(schema)).select(*names)

        def wanted(df: DataFrame) -> DataFrame:
            if keys is None:
                return df
            place = _CANONICAL if self._canonical(schema) else self.key
            return df.join(keys.select(F.col(keys.columns[0]).alias(place)), place, "left_semi")

        folded = wanted(self._read_base(schema, newest)) if newest else None
        if not written:
            return folded.select(*names)
        log = wanted(self._read_log(schema, written))
        if len({n for n, _ in written}) > 1:
            log = keep_last(log, self.key, "batch_id")
        log = log.select(*names)
        if folded is None:
            return log
        return folded.join(log.select(self.key), self.key, "left_anti").select(*names).unionByName(log)

    def slice(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """The current rows with these keys (one column; canonical URLs if the key is a URL).

        Their buckets are found first, so no other bucket is read; ``keys`` is used twice and
        should be at rest.
        """
        layout = self._layout(before)
        if layout is None:
            return None
        places = keys.select(self._bucket_of(F.col(keys.columns[0]), layout[0]).alias(_BUCKET)).distinct()
        # At most as many rows as the table has buckets.
        return self.current(before, {row[0] for row in places.collect()}, keys)

    def lookup(self, values: Sequence, before: int | None = None) -> DataFrame | None:
        """The current rows of a few key values, given on the driver.

        Reads their buckets, and of those the row groups whose range and bloom filter may hold
        one of the values.
        """
        layout = self._layout(before)
        if layout is None:
            return None
        buckets, schema = layout
        given = self.spark.createDataFrame([(v,) for v in values], T.StructType([schema[self.key]]))
        places = {row[_BUCKET] for row in self._bucketed(given, buckets, schema).select(_BUCKET).distinct().collect()}
        return self.current(before, places).where(F.col(self.key).isin(*values))

    # --- upkeep ----------------------------------------------------------------------

    def rows_since_fold(self) -> int:
        """Rows of the log that no fold covers yet (read from file footers)."""
        return sum(self._rows_by_bucket()[1].values())

    def _rows_by_bucket(self) -> tuple[dict[int, int], dict[int, int]]:
        """Rows of each bucket in the base and in the log behind it, from file footers."""
        newest, written = self._pending()
        counts: list[dict[int, int]] = []
        for rows in (
            self._read_base(self.schema(), newest) if newest else None,
            self._read_log(self.schema(), written) if written else None,
        ):
            found = rows.groupBy(_BUCKET).count().collect() if rows is not None else []
            counts.append({row[_BUCKET]: row["count"] for row in found})
        return counts[0], counts[1]

    def compact(self, buckets: Collection[int] | None = None) -> int | None:
        """Fold the log into new files of the buckets it touches; all others keep theirs.

        Files are sorted by key (and split by ``partition_by``) and carry a bloom filter of it,
        so a key lookup skips most row groups.  Older folds stay for readers that are on them.
        """
        _, written = self._pending()
        touched = {b for _, b in written if buckets is None or b in buckets}
        done = self.bases()
        if not touched:
            return done[-1] if done else None
        upto = max(self.batches())
        fold = max((f for (f,) in self._named("base/fold=*")), default=-1) + 1
        schema = self.schema()
        split = [self.partition_by] if self.partition_by else []
        rows = self.current(buckets=touched, hidden=True).withColumn("upto", F.lit(upto).cast("long"))
        writer = (
            rows.hint("rebalance", _BUCKET)
            .sortWithinPartitions(_BUCKET, *split, *self._order(schema))
            .write.partitionBy("upto", _BUCKET, *split)
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )
        self._save(writer, f"base/fold={fold}")
        return upto

    def maybe_compact(self, every: int | None, before: Callable[[], None] = lambda: None) -> bool:
        """Fold, once ``every`` rows have come since the last time, the buckets that are due.

        A bucket is due by the share of its rows that the log holds, or by the number of batches.
        ``before`` is called when there is something to fold.
        """
        if every is None or self._layout() is None:
            return False
        base, log = self._rows_by_bucket()
        if sum(log.values()) < every:
            return False
        times: dict[int, int] = {}
        for _, bucket in self._pending()[1]:
            times[bucket] = times.get(bucket, 0) + 1
        due = {
            bucket
            for bucket, rows in log.items()
            if rows >= FOLD_SHARE * base.get(bucket, 0) or times[bucket] >= FOLD_BATCHES
        }
        if not due:
            return False
        before()
        self.compact(due)
        self.expire()
        return True

    def expire(self, keep: int = 2) -> None:
        """Delete of each bucket all but the newest ``keep`` folds, and the log that those cover.

        With two kept, the newest batch can be replayed and a reader of the fold before goes on.
        """
        folds = self._folds()
        covered = {bucket: own[-keep][1] for bucket, own in folds.items() if len(own) >= keep}
        stale = [f"base/fold={f}/upto={n}/{_BUCKET}={b}" for b, own in folds.items() for f, n in own[:-keep]]
        stale += [f"log/batch_id={n}/{_BUCKET}={b}" for n, b in self._written() if n <= covered.get(b, -1)]
        self._delete(stale)
        left = {n for n, _ in self._written()}
        newest = max(self.batches(), default=-1)
        empty = [f"log/batch_id={n}" for n in self.batches() if n not in left and n < newest]
        live = {f for own in self._folds().values() for f, _ in own}
        empty += [f"base/fold={f}" for (f,) in self._named("base/fold=*/_SUCCESS") if f not in live]
        self._delete(empty)

    def _delete(self, folders: list[str]) -> None:
        for name in folders:
            remove_folder(self.spark, f"{self.path}/{name}")
