"""Page layout of grids as tables: column ranges, shifted cells, print areas, outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.functions import layout as lay
from tagloom.functions.bind import evaluate_once
from tagloom.functions.refs import ref_column

SHEET = ["workbook", "sheet_name"]
PAD_ATTRS = f'{{"customWidth":"1","width":"{lay.PAD_WIDTH}"}}'


def coalesce_ranges(columns: DataFrame, keys: list[str] = SHEET) -> DataFrame:
    """Merge neighbouring columns with equal attributes into ranges.

    ``columns(*keys, col_num, attrs)`` with comparable ``attrs``.  The window
    runs over the columns of one sheet, of which a file format allows 16,384.
    """
    along = W.partitionBy(*keys).orderBy("col_num")
    marked = columns.withColumn(
        "_new",
        F.coalesce(
            (F.lag("col_num").over(along) + 1 != F.col("col_num"))
            | ~F.lag("attrs").over(along).eqNullSafe(F.col("attrs")),
            F.lit(True),
        ).cast("int"),
    )
    return (
        marked.withColumn("_island", F.sum("_new").over(along))
        .groupBy(*keys, "_island")
        .agg(
            F.min("col_num").alias("start_col"),
            F.max("col_num").alias("end_col"),
            F.first("attrs").alias("attrs"),
        )
        .drop("_island")
    )


def paged_columns(ranges: DataFrame, max_columns: DataFrame) -> DataFrame:
    """Column attributes after the pad columns are in, as ranges.

    ``ranges(workbook, sheet_name, start_col, end_col, attrs)`` with ``attrs``
    as JSON text with sorted keys; ``max_columns(workbook, sheet_name, max_col)``.
    """
    moved = (
        ranges.filter(F.col("start_col") <= F.col("end_col"))
        .select(*SHEET, F.explode(F.sequence("start_col", "end_col")).alias("col_num"), "attrs")
        .withColumn("col_num", lay.shift_column(F.col("col_num")))
    )
    pages = lay.page_count(F.col("max_col"))
    pads = (
        max_columns.filter(pages > 0)
        .select(*SHEET, F.explode(F.sequence(F.lit(1), pages)).alias("page"))
        .select(*SHEET, lay.pad_column(F.col("page")).alias("col_num"), F.lit(PAD_ATTRS).alias("attrs"))
    )
    return coalesce_ranges(moved.unionByName(pads))


def sheet_max_columns(cells: DataFrame, dimensions: DataFrame | None = None) -> DataFrame:
    """Last column per sheet: the declared dimension if there is one, else the cells, at least 1."""
    used = cells.groupBy(*SHEET).agg(F.max("col_num").alias("used"))
    if dimensions is None:
        return used.select(*SHEET, F.greatest(F.lit(1), "used").alias("max_col"))
    last = F.element_at(F.split("ref", ":"), -1)
    declared = dimensions.select(*SHEET, ref_column(last).alias("declared"))
    return used.join(declared, SHEET, "full_outer").select(
        *SHEET, F.coalesce("declared", F.greatest(F.lit(1), "used")).alias("max_col")
    )


def paged_sheets(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("sheet_name").isin(*lay.UNPAGED_SHEETS))


def repaginate(cells: DataFrame) -> DataFrame:
    """Shift every cell of the laid-out sheets; the others stay. No shuffle."""
    unpaged = F.col("sheet_name").isin(*lay.UNPAGED_SHEETS)
    shifted = evaluate_once(cells, "_shifted", lay.shift_column(F.col("col_num")))
    return shifted.withColumn(
        "col_num", F.when(unpaged, F.col("col_num")).otherwise(F.col("_shifted"))
    ).drop("_shifted")


def print_areas(max_columns: DataFrame) -> DataFrame:
    return paged_sheets(max_columns).select(
        *SHEET, lay.print_area(F.col("sheet_name"), F.col("max_col")).alias("print_area")
    )


def without_sheet(sheets: DataFrame, removed: str | None) -> DataFrame:
    """Sheets that remain, with old and new position; later ones move down by one.

    The window runs over the sheet list of one workbook.
    """
    kept = sheets if removed is None else sheets.filter(F.col("sheet_name") != removed)
    position = F.row_number().over(W.partitionBy("workbook").orderBy("sheet_idx")) - 1
    return kept.withColumn("old_idx", F.col("sheet_idx")).withColumn("sheet_idx", position)


def defined_names_after_layout(
    names: DataFrame, sheets: DataFrame, areas: DataFrame, removed: str | None = None
) -> DataFrame:
    """Defined names once print areas are set and a sheet may be gone.

    ``names(workbook, name, local_sheet_id, text)``.  Scopes follow the moved
    sheets, names of the removed sheet go, and every old print area of a
    remaining sheet is replaced; sheets without a new one lose theirs.
    """
    kept = without_sheet(sheets, removed).select("workbook", "old_idx", "sheet_idx", "sheet_name")
    gone = (
        sheets.filter(F.lit(False)) if removed is None else sheets.filter(F.col("sheet_name") == removed)
    ).select("workbook", F.col("sheet_idx").alias("local_sheet_id"))
    scoped = names.join(gone, ["workbook", "local_sheet_id"], "left_anti").join(
        kept.select("workbook", F.col("old_idx").alias("local_sheet_id"), F.col("sheet_idx").alias("new_id")),
        ["workbook", "local_sheet_id"], "left",
    )
    replaced = (F.col("name") == lay.PRINT_AREA) & F.col("new_id").isNotNull()
    old = scoped.filter(~replaced).select(
        "workbook", "name", F.coalesce("new_id", "local_sheet_id").alias("local_sheet_id"), "text"
    )
    new = areas.join(kept, SHEET).select(
        "workbook", F.lit(lay.PRINT_AREA).alias("name"),
        F.col("sheet_idx").alias("local_sheet_id"), F.col("print_area").alias("text"),
    )
    return old.unionByName(new)


def active_tab_after(views: DataFrame, sheets: DataFrame, removed: str) -> DataFrame:
    """Active tab once a sheet is gone: the first one if it was active, else its new position."""
    gone = sheets.filter(F.col("sheet_name") == removed).select("workbook", F.col("sheet_idx").alias("gone"))
    tab = F.col("active_tab")
    return views.join(gone, "workbook", "left").select(
        "workbook",
        F.when(tab == F.col("gone"), F.lit(0)).when(tab > F.col("gone"), tab - 1).otherwise(tab).alias("active_tab"),
    )


def page_outlines(max_columns: DataFrame) -> DataFrame:
    """Cells of each page with flags for the sides that get an outline."""
    page = F.explode(F.sequence(F.lit(1), lay.page_count(F.col("max_col"))))
    first = F.lit(lay.FIRST_COLUMN) + (F.col("page") - 1) * lay.TOTAL_WIDTH
    return (
        paged_sheets(max_columns).filter(F.col("max_col") >= lay.FIRST_COLUMN)
        .select(*SHEET, page.alias("page"))
        .select("*", first.alias("start_col"))
        .select("*", F.explode(F.sequence(F.lit(lay.FIRST_ROW), F.lit(lay.LAST_ROW))).alias("row_num"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(lay.CONTENT_WIDTH - 1))).alias("step"))
        .select(
            *SHEET, "page", "row_num", (F.col("start_col") + F.col("step")).alias("col_num"),
            (F.col("step") == 0).alias("left_edge"),
            (F.col("step") == lay.CONTENT_WIDTH - 1).alias("right_edge"),
            (F.col("row_num") == lay.FIRST_ROW).alias("top_edge"),
            (F.col("row_num") == lay.LAST_ROW).alias("bottom_edge"),
        )
    )
