"""Additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_schema(
    base: T.StructType | None, incoming: T.StructType, primary_key: str
) -> T.StructType:
    """The ordered union of both: stored fields stay as they are, new ones follow.

    A new column without a type becomes a string, and a new key column takes no NULL.
    """
    stored = list(base) if base is not None else []
    names = {field.name for field in stored}
    added = [field for field in incoming if field.name not in names]
    union = T.StructType()
    for field in stored:
        union.add(field)
    for field in added:
        void = isinstance(field.dataType, T.NullType)
        union.add(field.name, T.StringType() if void else field.dataType, field.nullable)
    if primary_key not in union.names:
        raise ValueError(f"no column {primary_key!r}, which is the primary key")
    if primary_key not in names:
        union[primary_key].nullable = False
    return union


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; absent ones are NULL.

    A column of another type is an error; nothing is cast silently.
    """
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        found = df.schema[field.name].dataType
        if isinstance(found, T.NullType):
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif found.simpleString() != field.dataType.simpleString():
            raise TypeError(
                f"column {field.name!r} is {found.simpleString()}, "
                f"the table has {field.dataType.simpleString()}"
            )
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def evolve(
    stored: DataFrame, incoming: DataFrame, primary_key: str
) -> tuple[DataFrame, DataFrame, T.StructType]:
    """Both sides under the merged schema, and that schema."""
    schema = merge_schema(stored.schema, incoming.schema, primary_key)
    return conform(stored, schema), conform(incoming, schema), schema
