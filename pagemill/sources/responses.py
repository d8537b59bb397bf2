"""Captured responses as batch or streaming input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.binding import bind, over
from pagemill.functions.content import any_charset, content_type, decode_body
from pagemill.schemas import RESPONSE_SCHEMA


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).parquet(path)


def stream_responses(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Responses as they arrive; the limits bound one micro-batch (whole files)."""
    reader = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer partitions than there are cores.

    The HTML expressions are heavy on the CPU, so a small input in one file gains from a
    shuffle; an input with enough partitions is returned as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def lower_header_names(headers: Column) -> Column:
    """Headers with lower-case names; of names that collide the last value stays."""
    lowered = bind(
        "pairs",
        "transform(map_entries(h), pair -> struct(lower(pair.key) AS key, pair.value AS value))",
        """map_from_entries(filter(pairs, (pair, i) ->
            NOT exists(slice(pairs, i + 2, size(pairs)), later -> later.key = pair.key)))""",
    )
    return over(headers, "h", lowered)


def response_documents(responses: DataFrame) -> DataFrame:
    """Responses with lower-case header names, ``content_type`` and its lower-case form."""
    return (
        responses.withColumn("headers", lower_header_names(F.col("headers")))
        .withColumn("content_type", content_type(F.col("headers")))
        .withColumn("content_type_lower", F.lower("content_type"))
    )


def with_content(documents: DataFrame, needed: Column | None = None) -> DataFrame:
    """Add ``content``, the decoded body (of rows that are ``needed``, NULL in others)."""
    content = decode_body(F.col("body"), F.col("content_type"))
    with any_charset(documents.sparkSession):
        return documents.withColumn("content", content if needed is None else F.when(needed, content))
