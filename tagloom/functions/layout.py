"""Page layout arithmetic: one pad column follows each page of content columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.bind import let
from tagloom.functions.refs import RANGE, REF, cell_ref, column_letters, ref_column, ref_row

# --- fixed values ---------------------------------------------------------
FIRST_COLUMN = 2
CONTENT_WIDTH = 6
TOTAL_WIDTH = 7
FIRST_ROW = 2
LAST_ROW = 35
PAD_WIDTH = "0.875"
UNPAGED_SHEETS = ("주현황보고", "2026 list")
PRINT_AREA = "_xlnm.Print_Area"


def page_count(max_column: Column) -> Column:
    return F.when(max_column < FIRST_COLUMN, F.lit(0)).otherwise(
        F.ceil((max_column - FIRST_COLUMN + 1) / F.lit(CONTENT_WIDTH))
    ).cast("int")


def shift_column(column: Column) -> Column:
    """Where a content column lands once the pad columns are in."""
    passed = F.call_function("div", column - FIRST_COLUMN, F.lit(CONTENT_WIDTH))
    return F.when(column < FIRST_COLUMN, column).otherwise(column + passed).cast("int")


def pad_column(page: Column) -> Column:
    """Column of the pad that closes the 1-based page."""
    return (F.lit(FIRST_COLUMN - 1) + page * TOTAL_WIDTH).cast("int")


def shift_marker(zero_based_column: Column) -> Column:
    return shift_column(zero_based_column + 1) - 1


def print_area_end(max_column: Column) -> Column:
    return F.when(max_column < FIRST_COLUMN, F.lit(FIRST_COLUMN)).otherwise(
        shift_column(max_column) + 1
    )


def quoted_sheet(name: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(name, F.lit("'"), F.lit("''")), F.lit("'"))


def print_area(sheet_name: Column, max_column: Column) -> Column:
    return F.concat(
        quoted_sheet(sheet_name), F.lit("!$B$2:$"),
        let(print_area_end(max_column), column_letters), F.lit("$35"),
    )


def shift_ref(ref: Column) -> Column:
    moved = lambda r: let(ref_column(r), lambda c: let(shift_column(c), lambda m: cell_ref(ref_row(r), m)))
    return let(ref, moved)


def _shift_range(text: Column) -> Column:
    """A range with both corners moved."""
    left, right = F.split_part(text, F.lit(":"), F.lit(1)), F.split_part(text, F.lit(":"), F.lit(2))
    return F.concat_ws(":", shift_ref(left), shift_ref(right))


def shift_token(token: Column) -> Column:
    return (
        F.when(token.rlike(REF), shift_ref(token))
        .when(token.rlike(RANGE), _shift_range(token))
        .otherwise(token)
    )


def shift_ref_list(text: Column) -> Column:
    """Shift every reference or range of a white-space separated list."""
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    return F.array_join(F.transform(tokens, shift_token), " ")


def shift_span(span: Column) -> Column:
    """Shift an ``a:b`` column span."""
    start = F.split_part(span, F.lit(":"), F.lit(1)).cast("int")
    end = F.split_part(span, F.lit(":"), F.lit(2)).cast("int")
    return F.concat_ws(":", shift_column(start).cast("string"), shift_column(end).cast("string"))
