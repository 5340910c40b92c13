"""Evaluate an expression once and use its value many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, as a single expression.

    Columns are trees: an expression that mentions its input twenty times
    repeats the whole input twenty times.  A one-element ``transform`` binds it.
    """
    return F.transform(F.array(value), body)[0]


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that the optimizer never computes again.

    A filter on an ordinary projected column is pushed below the projection
    with the expression copied into it.  Output of ``explode`` is not, so
    costly columns that are filtered or used repeatedly go through a
    one-element ``explode``, which keeps every row.
    """
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != name],
        F.explode(F.array(value)).alias(name),
    )


def literal_list(values: list[str] | tuple[str, ...]) -> Column:
    """An array literal of strings without line breaks, in one expression instead of one per value."""
    return F.split(F.lit("\n".join(values)), "\n")
