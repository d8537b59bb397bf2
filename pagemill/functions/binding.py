"""Expressions written as SQL text over named values.

A long expression built call by call costs thousands of round trips to the JVM, and a value
used several times is evaluated several times.  Here an expression is one SQL text, and a
value is bound to a name through a one-element ``transform``, so it is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def over(value: Column, name: str, body: str) -> Column:
    """The SQL ``body`` with ``name`` standing for the column ``value``."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(0))
