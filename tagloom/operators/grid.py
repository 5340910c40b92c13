"""Grid operators: target rows, cards, fan-out of labels and the upsert.

A grid is ``cells(workbook, sheet_idx, sheet_name, row_num, col_num, value,
hyperlink, has_formula)`` with one row per cell; many workbooks share a table.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.functions import lexicon as lx
from tagloom.functions.bind import evaluate_once
from tagloom.functions.refs import cell_ref
from tagloom.functions.text import clean_title, final_label, link_text
from tagloom.operators.skew import spread_join

CELL_KEY = ["workbook", "sheet_name", "row_num", "col_num"]


@dataclass(frozen=True)
class CardRules:
    """Where the parts of a card lie, relative to its anchor column."""

    anchor_row: int = 2
    header_row: int = 5
    link_row: int = 4
    write_row: int = 5
    link_offset: int = 4
    write_offset: int = 1
    anchor_label: str = lx.CARD_ANCHOR
    header_label: str = lx.CARD_HEADER


@dataclass(frozen=True)
class TargetRules:
    """Where the rows to be labelled stand; rows outside the range are no targets."""

    sheet: str = lx.TARGET_SHEET
    marker: str = lx.TARGET_MARKER
    marker_column: int = lx.TARGET_COLUMN
    title_column: int = lx.TITLE_COLUMN
    link_column: int = lx.LINK_COLUMN
    first_row: int = lx.START_ROW
    last_row: int = lx.END_ROW


def target_rows(cells: DataFrame, rules: TargetRules = TargetRules()) -> DataFrame:
    """Rows still to be labelled: ``(workbook, row_num, title, link)``.

    One shuffle with map-side combining.  A workbook gives at most one target
    per row of the range.
    """
    at = F.col("col_num")
    link = link_text(F.col("hyperlink"), F.col("value"))
    wide = (
        cells.filter(
            (F.col("sheet_name") == rules.sheet)
            & F.col("row_num").between(rules.first_row, rules.last_row)
            & at.isin(rules.marker_column, rules.title_column, rules.link_column)
        )
        .groupBy("workbook", "row_num")
        .agg(
            F.max(F.when(at == rules.marker_column, F.col("value"))).alias("marker"),
            F.max(F.when(at == rules.title_column, F.col("value"))).alias("title"),
            F.max(F.when(at == rules.link_column, link)).alias("link"),
        )
    )
    return targets_of_list(wide, rules)


def targets_of_list(posts: DataFrame, rules: TargetRules = TargetRules()) -> DataFrame:
    """The same from a wide list ``(workbook, row_num, marker, title, link)``; no shuffle."""
    marked = posts.filter(
        F.col("row_num").between(rules.first_row, rules.last_row) & (F.col("marker") == rules.marker)
    )
    titled = evaluate_once(marked, "title", clean_title(F.col("title")))
    return titled.filter(F.col("title").isNotNull()).select(
        "workbook", "row_num", "title",
        F.when(F.col("link") != "", F.col("link")).alias("link"),
    )


def target_counts(targets: DataFrame) -> DataFrame:
    return targets.groupBy("workbook").agg(F.count("*").alias("n_targets"))


def card_cells(
    cells: DataFrame,
    rules: CardRules | DataFrame = CardRules(),
    skip_final: bool = True,
) -> DataFrame:
    """Writable cells of all cards: ``(workbook, link, sheet_idx, sheet_name, row_num, col_num)``.

    ``rules`` holds for all workbooks, or is a table with one row per workbook
    and the fields of ``CardRules``; workbooks that it lacks have no cards, and
    sheets outside its ``sheets`` list, where it has one, are not read.

    Each cell on a card row names the anchor columns it could belong to and its
    part there; one aggregate per anchor column then puts the parts together.
    That takes one shuffle where a self-join per part would take four.
    """
    if isinstance(rules, CardRules):
        rule = {f.name: F.lit(getattr(rules, f.name)) for f in fields(CardRules)}
        ruled = cells
    else:
        rule = {f.name: F.col(f"_rule.{f.name}") for f in fields(CardRules)}
        ruled = cells.join(rules.select("workbook", F.struct(*rules.drop("workbook").columns).alias("_rule")), "workbook")
        if "sheets" in rules.columns:
            listed = F.col("_rule.sheets")
            ruled = ruled.filter(listed.isNull() | F.array_contains(listed, F.col("sheet_name")))
    row, col, value = F.col("row_num"), F.col("col_num"), F.col("value")
    link = link_text(F.col("hyperlink"), value)

    def part(at_row: str, offset: Column, name: str, keep: Column, text: Column) -> Column:
        return F.when(
            (row == rule[at_row]) & (col - offset >= 1) & keep,
            F.struct((col - offset).cast("int").alias("anchor_col"), F.lit(name).alias("part"), text.alias("text")),
        )

    parts = [
        part("anchor_row", F.lit(0), "anchor", value == rule["anchor_label"], F.lit("")),
        part("header_row", F.lit(0), "header", value == rule["header_label"], F.lit("")),
        part("link_row", rule["link_offset"], "link", link.isNotNull(), link),
    ]
    if skip_final:
        parts.append(part("write_row", rule["write_offset"], "final", final_label(value), F.lit("")))
    has_part = lambda name: F.count_if(F.col("part") == name) > 0
    place = [F.first(rule["write_row"]).alias("row_num"), F.first(rule["write_offset"]).alias("write_offset")]
    keep = [] if isinstance(rules, CardRules) else ["_rule"]

    found = (
        ruled.filter(row.isin(rule["anchor_row"], rule["header_row"], rule["link_row"], rule["write_row"]))
        .select("workbook", "sheet_idx", "sheet_name", *keep, F.inline(F.array(*parts)))
        .filter(F.col("part").isNotNull())
        .groupBy("workbook", "sheet_idx", "sheet_name", "anchor_col")
        .agg(
            has_part("anchor").alias("anchor"),
            has_part("header").alias("header"),
            has_part("final").alias("final"),
            F.max(F.when(F.col("part") == "link", F.col("text"))).alias("link"),
            *place,
        )
    )
    whole = F.col("anchor") & F.col("header") & ~F.col("final") & F.col("link").isNotNull()
    return found.filter(whole).select(
        "workbook", "link", "sheet_idx", "sheet_name", F.col("row_num").cast("int").alias("row_num"),
        (F.col("anchor_col") + F.col("write_offset")).cast("int").alias("col_num"),
    )


def card_positions(cards: DataFrame) -> DataFrame:
    """Cards nested per link: positions in sheet order, then column.

    For a report on request; a link's list is no longer than the cards of one file.
    """
    place = F.struct("sheet_idx", "sheet_name", "row_num", "col_num")
    return cards.groupBy("workbook", "link").agg(F.array_sort(F.collect_list(place)).alias("positions"))


# --- updates --------------------------------------------------------------------
# ``updates(workbook, sheet_idx, sheet_name, row_num, col_num, value, seq)``;
# ``seq`` is the order in which one program would write them: target row, own
# cell before cards, sheet, column.  ``sheet_idx`` is NULL for a result's own
# cell, which is in the grid already.


def _seq(row: Column, branch: int, sheet: Column, col: Column) -> Column:
    return F.struct(
        row.cast("int").alias("target_row"), F.lit(branch).alias("branch"),
        sheet.cast("int").alias("sheet_idx"), col.cast("int").alias("col_num"),
    )


def own_updates(results: DataFrame, rules: TargetRules = TargetRules()) -> DataFrame:
    """Each result written to its own cell of the target sheet."""
    zero = F.lit(0)
    return results.select(
        "workbook", F.lit(None).cast("int").alias("sheet_idx"), F.lit(rules.sheet).alias("sheet_name"),
        F.col("row_num").cast("int").alias("row_num"),
        F.lit(rules.marker_column).alias("col_num"), F.col("category").alias("value"),
        _seq(F.col("row_num"), 0, zero, zero).alias("seq"),
    )


def _card_updates(results: DataFrame, cards: DataFrame, unique: bool = False) -> DataFrame:
    """Each result on every card of its link; ``unique`` says that a link has one result."""
    linked = results.filter(F.col("link").isNotNull()).select(
        "workbook", "link", F.col("row_num").alias("target_row"), "category"
    )
    places = cards.select("workbook", "link", "sheet_idx", "sheet_name", "row_num", "col_num")
    met = linked.join(places, ["workbook", "link"]) if unique else spread_join(places, linked, ["workbook", "link"], [F.col(c) for c in places.columns])
    return met.select(
        "workbook", F.col("sheet_idx").cast("int").alias("sheet_idx"), "sheet_name", "row_num", "col_num",
        F.col("category").alias("value"),
        _seq(F.col("target_row"), 1, F.col("sheet_idx"), F.col("col_num")).alias("seq"),
    )


def fan_out(results: DataFrame, cards: DataFrame, rules: TargetRules = TargetRules()) -> DataFrame:
    """Every update of every result, superseded ones included.

    A workbook has at most one target per row of the range, so a card gets no
    more updates than that.  Cards are dealt out over parts and the results
    repeated for each, so that the pairs of a hot link are many tasks' work.
    """
    return own_updates(results, rules).unionByName(_card_updates(results, cards))


def winning_updates(results: DataFrame, cards: DataFrame, rules: TargetRules = TargetRules()) -> DataFrame:
    """The one update per cell that remains after all of ``fan_out`` is applied.

    The last result per link is found before the join, so each card meets one
    row and superseded pairs are never built.
    """
    last = (
        results.filter(F.col("link").isNotNull())
        .groupBy("workbook", "link")
        .agg(F.max(F.struct("row_num", "category")).alias("last"))
        .select("workbook", "link", "last.row_num", "last.category")
    )
    return last_writes(own_updates(results, rules).unionByName(_card_updates(last, cards, unique=True)))


def last_writes(updates: DataFrame, keys: list[str] = CELL_KEY) -> DataFrame:
    """The last update per cell, by ``seq``."""
    return (
        updates.groupBy(*keys)
        .agg(F.max(F.struct("seq", "value", "sheet_idx")).alias("last"))
        .select(*keys, "last.value", "last.seq", "last.sheet_idx")
    )


def writable_places(rules: CardRules = CardRules(), targets: TargetRules = TargetRules()) -> Column:
    """Condition that every cell a label can be written to fulfils."""
    own = (F.col("sheet_name") == targets.sheet) & (F.col("col_num") == targets.marker_column)
    return own | (F.col("row_num") == rules.write_row)


def upsert(cells: DataFrame, winners: DataFrame, places: Column | None = None) -> DataFrame:
    """Write one value per cell into the grid.

    Absent cells are created on the sheet of their card, formula cells keep
    what they hold, all others stay.  ``places`` is a condition all winners fulfil: cells outside it pass
    by without a shuffle, which leaves little of a wide grid to join.
    """
    new = winners.select(*CELL_KEY, F.col("value").alias("new_value"), F.col("sheet_idx").alias("new_sheet_idx"))
    formula = F.coalesce("has_formula", F.lit(False))
    written = (
        (cells if places is None else cells.filter(places)).join(new, CELL_KEY, "full_outer")
        .withColumn("value", F.when(formula, F.col("value")).otherwise(F.coalesce("new_value", "value")))
        .withColumn("sheet_idx", F.coalesce("sheet_idx", "new_sheet_idx"))
        .withColumn("has_formula", formula)
        .drop("new_value", "new_sheet_idx")
    )
    if places is None:
        return written
    aside = cells.filter(~F.coalesce(places, F.lit(False))).withColumn("has_formula", formula)
    return written.unionByName(aside)


def updates_by_sheet(winners: DataFrame) -> DataFrame:
    """Updates nested per sheet as a map from reference to value.

    Bounded by the target rows and cards of one sheet.
    """
    entry = F.struct(cell_ref(F.col("row_num"), F.col("col_num")).alias("key"), F.col("value").alias("value"))
    return winners.groupBy("workbook", "sheet_name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells")
    )


# --- reports ----------------------------------------------------------------------


def category_summary(results: DataFrame, labels: tuple[str, ...] = lx.CATEGORIES) -> DataFrame:
    """Rows per workbook and label, zeros included, without a join."""
    counts = results.groupBy("workbook").agg(
        *[F.count_if(F.col("category") == label).alias(f"n{i}") for i, label in enumerate(labels)]
    )
    pairs = F.array(
        *[F.struct(F.lit(label).alias("category"), F.col(f"n{i}").alias("n")) for i, label in enumerate(labels)]
    )
    return counts.select("workbook", F.inline(pairs))


def method_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("workbook", "method").agg(F.count("*").alias("n"))


def progress(results: DataFrame) -> DataFrame:
    """Running number and total per workbook, and the line a run would print.

    A window over a workbook sees no more rows than the target range has.
    """
    book = W.partitionBy("workbook")
    numbered = results.withColumn("idx", F.row_number().over(book.orderBy("row_num"))).withColumn(
        "total", F.count("*").over(book)
    )
    line = F.format_string(
        "[%d/%d] row=%d (%s) -> %s", F.col("idx"), F.col("total"), F.col("row_num"),
        F.col("method"), F.col("category"),
    )
    return numbered.select("workbook", "row_num", "idx", "total", line.alias("line"))
