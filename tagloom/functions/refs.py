"""Cell references: ``A1`` text to numbers and back, and ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REF = "^([A-Z]+)([0-9]+)$"
RANGE = "^[A-Z]+[0-9]+:[A-Z]+[0-9]+$"
# Seven letters cover every positive INT.
MAX_LETTERS = 7


def column_number(letters: Column) -> Column:
    """Base-26 column letters (no zero digit) to a 1-based number."""
    return F.aggregate(
        F.split(letters, ""),
        F.lit(0),
        lambda acc, c: acc * 26 + F.ascii(c) - 64,
    )


def column_letters(number: Column) -> Column:
    """1-based column number to base-26 letters.  Mentions its input often: bind a costly one with ``let``."""
    n, parts = number.cast("bigint"), []
    for power in reversed(range(MAX_LETTERS)):
        below = sum(26**p for p in range(1, power + 1))
        digit = F.char(F.lit(65) + F.call_function("div", n - 1 - below, F.lit(26**power)) % 26)
        parts.append(digit if power == 0 else F.when(n > below, digit).otherwise(""))
    return F.concat(*parts)


def cell_ref(row: Column, column: Column) -> Column:
    return F.concat(column_letters(column), row.cast("string"))


def is_cell_ref(ref: Column) -> Column:
    return ref.rlike(REF)


def ref_row(ref: Column) -> Column:
    """Row number of a reference; a malformed one gives NULL."""
    return F.when(is_cell_ref(ref), F.regexp_extract(ref, REF, 2)).cast("int")


def ref_column(ref: Column) -> Column:
    """Column number of a reference; a malformed one gives NULL."""
    return F.when(is_cell_ref(ref), column_number(F.regexp_extract(ref, REF, 1)))


def checked_ref(ref: Column) -> Column:
    """The reference itself; a malformed one fails the job."""
    return F.when(is_cell_ref(ref), ref).otherwise(
        F.raise_error(F.concat(F.lit("invalid cell reference "), ref))
    )
