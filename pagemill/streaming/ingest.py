"""Continuous import: responses arrive as files, every micro-batch is one import run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagemill.operators.boilerplate import HostBlocks
from pagemill.operators.search import TermIndex
from pagemill.plans.importing import (
    Counters,
    ProgressCallback,
    StoredFrontier,
    commit,
    frontier_table_at,
    page_table_at,
    plan_import,
)
from pagemill.schemas import ImportOptions
from pagemill.sources.responses import stream_responses


def micro_batch_writer(
    spark: SparkSession,
    table: str,
    options: ImportOptions,
    first_batch: int = 0,
    progress: ProgressCallback | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that imports a micro-batch into ``table``.

    Page rows are written before the URL states that call them done.  A replayed batch sees
    the tables as they were before it and replaces what it wrote.  Of the stored states only the
    buckets of the batch's URLs are read.  ``progress`` gets the stages of every micro-batch.
    """
    pages = page_table_at(spark, table, options)
    states = frontier_table_at(spark, f"{table}__frontier", options)
    index = TermIndex(spark, f"{table}__terms", options.primary_key) if options.indexed else None
    blocks = HostBlocks(spark, f"{table}__blocks") if options.drop_boilerplate else None

    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = first_batch + epoch
        counters = Counters(progress or (lambda _: None))
        counters.stage("started")
        plan = plan_import(batch, options, StoredFrontier(states, batch_id))
        written = commit(plan, pages, states, batch_id, options, counters, index, blocks)
        if blocks is not None:
            blocks.fold(options.optimize_every)
        for stored in (pages, states) if written else (states,):
            if stored.maybe_compact(options.optimize_every, lambda: counters.stage("optimizing")):
                counters.stage("optimized")
        counters.stage("completed", result=counters.result())

    return write


def start_ingest(
    spark: SparkSession,
    responses: DataFrame | str,
    table: str,
    options: ImportOptions | None = None,
    available_now: bool = False,
    progress: ProgressCallback | None = None,
) -> StreamingQuery:
    """Import a stream of responses, or of the files of a folder, into ``table``.

    Offsets are kept in ``<table>__checkpoint``, so a restart goes on where it stopped.  A
    batch is cut every ``max_batch_delay`` seconds, and earlier files are left for the next one
    when those of a folder pass ``max_batch_bytes``; ``available_now`` drains what is there
    and stops.
    """
    options = options or ImportOptions()
    if options.limit is not None:
        raise ValueError("limit applies to batch imports")
    for name in ("include_sitemap", "retry_failed"):
        if getattr(options, name):
            raise ValueError(f"{name} applies to batch imports")
    if isinstance(responses, str):
        responses = stream_responses(spark, responses, max_bytes_per_trigger=options.max_batch_bytes)
    elif options.max_batch_bytes is not None:
        raise ValueError("max_batch_bytes applies to a stream given by its folder")
    table = table.rstrip("/")
    checkpoint = f"{table}__checkpoint"
    first = _first_batch(spark, table, checkpoint, options)
    trigger = (
        {"availableNow": True}
        if available_now
        else {"processingTime": f"{options.max_batch_delay or 0} seconds"}
    )
    return (
        responses.writeStream.foreachBatch(micro_batch_writer(spark, table, options, first, progress))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _first_batch(spark: SparkSession, table: str, checkpoint: str, options: ImportOptions) -> int:
    """The table batch of the stream's first epoch, fixed when the checkpoint is new."""
    marker = f"{checkpoint}_start"
    jvm = spark._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{marker}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        pages = page_table_at(spark, table, options)
        states = frontier_table_at(spark, f"{table}__frontier", options)
        first = max(pages.next_batch(), states.next_batch())
        spark.range(first, first + 1).write.mode("overwrite").parquet(marker)
    return spark.read.parquet(marker).first()["id"]
