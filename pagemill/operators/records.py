"""From accepted responses to page rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.content import is_html, strip_html
from pagemill.functions.html import html_markdown, html_text, image_structs
from pagemill.schemas import IMAGE_TYPE, ImportOptions
from pagemill.sources.responses import with_content


def iso_utc(moment: Column) -> Column:
    """ISO-8601 in UTC with a ``Z``, whatever the session time zone is."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def formatted_text(content: Column, kind: Column, content_format: str) -> Column:
    """HTML as markdown, HTML or text; other content as it is."""
    if content_format == "html":
        return content
    render = html_markdown if content_format == "md" else html_text
    return F.when(is_html(kind), render(content)).otherwise(content)


def page_images(content: Column, kind: Column) -> Column:
    return F.when(is_html(kind), image_structs(content)).otherwise(F.array().cast(T.ArrayType(IMAGE_TYPE)))


def page_records(documents: DataFrame, options: ImportOptions | None = None) -> DataFrame:
    """``seq, url, date, content_type, text, images`` of each accepted response.

    Images come from the stripped content, or from the raw one with ``after-links``; the
    text always comes from the stripped content.
    """
    options = options or ImportOptions()
    pages = documents if "content" in documents.columns else with_content(documents)
    return with_stripped(pages, options).select("seq", "url", *record_columns(options))


def with_stripped(pages: DataFrame, options: ImportOptions) -> DataFrame:
    """Pages with ``content`` and ``_stripped``, what the strip steps leave of it."""
    stripped = strip_html(F.col("content"), F.col("content_type"), options.kinds)
    return pages.withColumn("_stripped", stripped)


def record_columns(options: ImportOptions) -> list[Column]:
    """``date, content_type, text, images`` over the columns of :func:`with_stripped`."""
    kind = F.col("content_type")
    return [
        iso_utc(F.col("fetched_at")).alias("date"),
        kind,
        formatted_text(F.col("_stripped"), kind, options.content_format).alias("text"),
        images_in_order(options).alias("images"),
    ]


def images_in_order(options: ImportOptions) -> Column:
    """The images of a page, taken before or after the strip steps."""
    source = F.col("_stripped" if options.order == "before-links" else "content")
    return page_images(source, F.col("content_type"))


def pandas_extractor(
    function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> Callable[[DataFrame], DataFrame]:
    """An extractor from a function over Arrow batches of responses; dropped rows are skipped."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return lambda documents: documents.mapInPandas(apply, schema)


def _octets(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("long")
    elif isinstance(kind, T.BooleanType):
        size = F.when(value.isNotNull(), F.lit(1).cast("long"))
    elif isinstance(kind, T.NumericType):
        size = F.when(value.isNotNull(), F.lit(8).cast("long"))
    elif isinstance(kind, T.StructType):
        names = sum(len(field.name.encode()) for field in kind.fields)
        size = F.when(value.isNotNull(), F.lit(names).cast("long"))
        for field in kind.fields:
            size = size + _octets(value[field.name], field.dataType)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(
            value,
            F.lit(0).cast("long"),
            lambda total, item: total + _octets(item, kind.elementType),
        )
    elif isinstance(kind, T.MapType):
        size = _octets(F.map_keys(value), T.ArrayType(kind.keyType)) + _octets(
            F.map_values(value), T.ArrayType(kind.valueType)
        )
    else:
        size = F.octet_length(value.cast("string")).cast("long")
    return F.coalesce(size, F.lit(0).cast("long"))


def record_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The estimated size of a row as a mapping: column names and values in octets.

    Strings count their UTF-8 octets, booleans 1, numbers 8, NULL 0.
    """
    names = columns or df.columns
    total = F.lit(sum(len(name.encode()) for name in names)).cast("long")
    for name in names:
        total = total + _octets(F.col(name), df.schema[name].dataType)
    return total
