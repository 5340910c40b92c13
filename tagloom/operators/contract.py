"""Workbook contracts: what a supported workbook looks like and where it may be written.

``contracts`` has one row per family, workbooks name their family.  Nested
values are sorted arrays of ``(key, value)`` entries, as maps cannot be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.refs import cell_ref, checked_ref, ref_column, ref_row
from tagloom.operators.grid import CardRules

# --- fixed values: writers and policy ------------------------------------------
PRIMARY_WRITER = "primary_template_value_only"
NO_WRITER = "unsupported_variant"
POLICY = "hard_fail"

# --- fixed values: reason codes and messages -------------------------------------
REASONS = {
    "unsupported_sheet_count": "sheet count differs from supported workbook family",
    "unsupported_missing_target_sheet": "missing required sheet ",
    "unsupported_sheet_order": "sheet order differs from supported workbook family",
    "unsupported_sheet_state": "sheet hidden-state map differs from supported workbook family",
    "unsupported_missing_linked_card_layout": "linked-card write targets differ from supported workbook family",
    "unsupported_workbook_family_signature": "workbook.xml fingerprint differs from supported workbook family",
}
# Own reasons: what cannot be checked is not supported.
UNCHECKED = {
    "unsupported_missing_contract": "no contract for this workbook family",
    "unsupported_ambiguous_contract": "several contracts for this workbook family",
    "unsupported_missing_catalogue": "the sheet catalogue of the workbook cannot be read",
    "unsupported_unreadable_part": "a part of the workbook cannot be read: ",
}

EMPTY_REFS = "array<string>"
TARGET_ENTRY = "array<struct<key:string,value:array<string>>>"


# --- contract values --------------------------------------------------------------


def sorted_entries(mapping: Column) -> Column:
    return F.array_sort(F.map_entries(mapping))


def allowed_hashes(single: Column, several: Column) -> Column:
    """Union of the single hash and the list; empty means no check."""
    one = F.filter(F.array(single), lambda h: h.isNotNull() & (h != ""))
    return F.array_union(one, F.coalesce(several, F.array().cast("array<string>")))


def state_variants(several: Column, single: Column) -> Column:
    """The list of state maps if it has any, else the single map, else none."""
    entries = "array<array<struct<key:string,value:string>>>"
    return (
        F.when(F.size(several) > 0, F.transform(several, sorted_entries))
        .when(F.size(single) > 0, F.array(sorted_entries(single)))
        .otherwise(F.array().cast(entries))
    )


def target_variant(text: Column) -> Column:
    """Sorted (sheet, references) entries of one JSON object; not an object gives NULL."""
    sheets = F.map_entries(F.from_json(text, "map<string,string>"))
    refs = lambda v: F.coalesce(F.from_json(v, EMPTY_REFS), F.array().cast(EMPTY_REFS))
    entry = lambda e: F.struct(e["key"].alias("key"), refs(e["value"]).alias("value"))
    is_object = F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT")
    return F.when(is_object, F.array_sort(F.transform(sheets, entry)))


def target_variants(single: Column, several: Column) -> Column:
    """Card target variants of a contract, from JSON text.

    The single value and the list both count.  Entries that are not objects are
    left out; references that are not a list count as none.
    """
    texts = F.concat(
        F.array(single),
        F.coalesce(F.from_json(several, EMPTY_REFS), F.array().cast(EMPTY_REFS)),
    )
    return F.array_distinct(
        F.filter(F.transform(texts, target_variant), lambda v: v.isNotNull())
    )


def normalise_contracts(raw: DataFrame) -> DataFrame:
    """Flatten contracts as read from JSON to the columns the checks use.

    ``card_rules`` keeps the contract's own offsets and labels.
    """
    family, topology, surface = (
        "supported_workbook_family", "preserved_topology", "writable_surface",
    )
    return raw.select(
        "family",
        F.col(f"{topology}.sheet_count").alias("sheet_count"),
        F.col(f"{topology}.sheet_order").alias("sheet_order"),
        state_variants(
            F.col(f"{topology}.sheet_states_variants"), F.col(f"{topology}.sheet_states")
        ).alias("state_variants"),
        F.col(f"{surface}.primary_target.sheet_name").alias("target_sheet"),
        F.col(f"{surface}.primary_target.allowed_ranges").alias("allowed_ranges"),
        F.col(f"{surface}.linked_card_rules").alias("card_rules"),
        target_variants(
            F.col(f"{surface}.linked_card_targets"),
            F.col(f"{surface}.linked_card_targets_variants"),
        ).alias("card_variants"),
        allowed_hashes(
            F.col(f"{family}.workbook_xml_sha256"),
            F.col(f"{family}.workbook_xml_sha256_allowlist"),
        ).alias("hashes"),
    )


def contract_card_rules(workbooks: DataFrame, contracts: DataFrame) -> DataFrame:
    """The card rules of each workbook's family, for ``grid.card_cells``, and the sheets that may hold cards.

    A field that the contract leaves out has its default.
    """
    default = CardRules()
    named = {
        "anchor_row": "card_anchor_row", "header_row": "header_row", "link_row": "link_row", "write_row": "write_row",
        "link_offset": "link_column_offset_from_anchor", "write_offset": "write_column_offset_from_anchor",
        "anchor_label": "card_anchor_label", "header_label": "header_label",
    }
    rules = contracts.dropDuplicates(["family"]).select(
        "family", F.col("sheet_order").alias("sheets"),
        *[F.coalesce(F.col(f"card_rules.{theirs}"), F.lit(getattr(default, ours))).alias(ours) for ours, theirs in named.items()],
    )
    return workbooks.select("workbook", "family").join(rules, "family").drop("family")


# --- the workbook's own values --------------------------------------------------------


def card_targets(cards: DataFrame, sheets: DataFrame) -> DataFrame:
    """Writable card cells per workbook as sorted (sheet, references) entries.

    References run by anchor column; a sheet without cards has no entry.
    Bounded by the cards of one file.
    """
    places = cards.groupBy("workbook", "sheet_name").agg(
        F.array_sort(
            F.collect_list(F.struct("col_num", cell_ref(F.col("row_num"), F.col("col_num")).alias("ref")))
        )["ref"].alias("refs")
    )
    known = places.join(sheets.select("workbook", "sheet_name"), ["workbook", "sheet_name"], "left_semi")
    return known.groupBy("workbook").agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("sheet_name").alias("key"), F.col("refs").alias("value")))
        ).alias("card_targets")
    )


def fingerprints(sheets: DataFrame, workbooks: DataFrame, targets: DataFrame) -> DataFrame:
    """What the contract is checked against, one row per workbook.

    ``workbooks(workbook, family, file_sha256, workbook_xml_sha256)``; the sheet
    list of one workbook is as long as its catalogue part.
    """
    order = F.array_sort(F.collect_list(F.struct("sheet_idx", "sheet_name")))["sheet_name"]
    states = F.array_sort(
        F.collect_set(F.struct(F.col("sheet_name").alias("key"), F.col("state").alias("value")))
    )
    catalogue = sheets.groupBy("workbook").agg(
        order.alias("sheet_order"), states.alias("sheet_states")
    )
    return (
        workbooks.join(catalogue, "workbook", "left")
        .join(targets, "workbook", "left")
        .withColumn("card_targets", F.coalesce("card_targets", F.array().cast(TARGET_ENTRY)))
    )


# --- checks ------------------------------------------------------------------------------


def check_contracts(prints: DataFrame, contracts: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """First failing check of each workbook: ``(workbook, family, code, detail)``, NULL when all pass.

    A workbook whose family has no contract or several, that has no sheet
    catalogue, or that has a row in ``unreadable(workbook, part)`` fails; a
    value that is missing on either side differs.
    """
    columns = ["sheet_order", "sheet_count", "target_sheet", "state_variants", "card_variants", "hashes"]
    rules = contracts.groupBy("family").agg(
        F.count("*").alias("n_contracts"), *[F.first(c).alias(f"want_{c}") for c in columns]
    )
    broken = (
        prints.select("workbook", F.lit(None).cast("string").alias("bad_part")).limit(0)
        if unreadable is None
        else unreadable.groupBy("workbook").agg(F.min("part").alias("bad_part"))
    )
    both = prints.join(rules, "family", "left").join(broken, "workbook", "left")
    messages = REASONS | UNCHECKED
    fail = lambda code, more="": F.struct(
        F.lit(code).alias("code"), F.concat(F.lit(messages[code]), more if isinstance(more, Column) else F.lit(more)).alias("detail")
    )
    holds = lambda values, value: F.coalesce(F.array_contains(values, value), F.lit(False))
    demanded = lambda values: F.coalesce(F.size(values) > 0, F.lit(False))
    names = F.transform("sheet_states", lambda s: s["key"])
    first = (
        F.when(F.col("n_contracts").isNull(), fail("unsupported_missing_contract"))
        .when(F.col("n_contracts") > 1, fail("unsupported_ambiguous_contract"))
        .when(F.col("bad_part").isNotNull(), fail("unsupported_unreadable_part", F.col("bad_part")))
        .when(F.col("sheet_order").isNull(), fail("unsupported_missing_catalogue"))
        .when(~F.col("want_sheet_count").eqNullSafe(F.size("sheet_order")), fail("unsupported_sheet_count"))
        .when(
            ~holds(names, F.col("want_target_sheet")),
            fail("unsupported_missing_target_sheet", F.coalesce("want_target_sheet", F.lit(""))),
        )
        .when(~F.col("sheet_order").eqNullSafe(F.col("want_sheet_order")), fail("unsupported_sheet_order"))
        .when(
            demanded(F.col("want_state_variants")) & ~holds(F.col("want_state_variants"), F.col("sheet_states")),
            fail("unsupported_sheet_state"),
        )
        .when(
            demanded(F.col("want_card_variants")) & ~holds(F.col("want_card_variants"), F.col("card_targets")),
            fail("unsupported_missing_linked_card_layout"),
        )
        .when(
            demanded(F.col("want_hashes")) & ~holds(F.col("want_hashes"), F.col("workbook_xml_sha256")),
            fail("unsupported_workbook_family_signature"),
        )
    )
    return both.select("workbook", "family", first.alias("f")).select("workbook", "family", "f.code", "f.detail")


def range_bounds(ranges: DataFrame, range_col: str = "cell_range") -> DataFrame:
    """Corners of each ``A1:B9`` rectangle as ``low_row, high_row, low_col, high_col``; reversed bounds are left out."""
    start = F.split_part(F.col(range_col), F.lit(":"), F.lit(1))
    end = F.split_part(F.col(range_col), F.lit(":"), F.lit(2))
    return ranges.select(
        "*",
        ref_row(checked_ref(start)).alias("low_row"), ref_row(checked_ref(end)).alias("high_row"),
        ref_column(start).alias("low_col"), ref_column(end).alias("high_col"),
    ).filter((F.col("low_row") <= F.col("high_row")) & (F.col("low_col") <= F.col("high_col")))


def expand_ranges(ranges: DataFrame, range_col: str = "cell_range") -> DataFrame:
    """Every cell of each ``A1:B9`` rectangle; for reports that name cells, not for tests of membership."""
    return (
        range_bounds(ranges, range_col)
        .withColumn("row_num", F.explode(F.sequence("low_row", "high_row")))
        .withColumn("col_num", F.explode(F.sequence("low_col", "high_col")))
        .drop("low_row", "high_row", "low_col", "high_col")
        .withColumn("cell_ref", cell_ref(F.col("row_num"), F.col("col_num")))
    )


def writable_surface(primary: DataFrame, cards: DataFrame) -> DataFrame:
    """Distinct ``(workbook, sheet_name, cell_ref)`` that may be written.

    ``primary(workbook, sheet_name, cell_range)``; ``cards`` are the workbook's
    own card cells, which take the place of those in the contract.

    Overlaps are taken out of the bounds before any cell is named: in each
    column a range gives only the rows below those that earlier ranges reach.
    So cells are neither moved nor kept to be told apart, only bounds are.
    """
    column = ["workbook", "sheet_name", "col_num"]
    ranged = range_bounds(primary.select("workbook", "sheet_name", "cell_range").distinct()).select(
        "workbook", "sheet_name", F.explode(F.sequence("low_col", "high_col")).alias("col_num"), "low_row", "high_row"
    )
    # a card without a place is one row without a reference
    placed = lambda name: F.when(F.col("row_num").isNotNull() & F.col("col_num").isNotNull(), F.col(name)).alias(name)
    own = cards.select("workbook", "sheet_name", placed("row_num"), placed("col_num")).select(
        *column, F.col("row_num").alias("low_row"), F.col("row_num").alias("high_row")
    )
    down = Window.partitionBy(*column).orderBy("low_row", "high_row")
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.col("high_row").cast("long")).over(above)
    pieces = ranged.unionByName(own).select(
        *column, "high_row", F.greatest(F.col("low_row").cast("long"), reached + 1).alias("from_row"), F.row_number().over(down).alias("nth")
    ).filter("from_row <= high_row OR (from_row IS NULL AND nth = 1)")
    return pieces.select(*column, F.explode_outer(F.sequence("from_row", F.col("high_row").cast("long"))).alias("row_num")).select(
        "workbook", "sheet_name", cell_ref(F.col("row_num"), F.col("col_num")).alias("cell_ref")
    )


# How fine the bins of ``outside`` are: rows and columns of a bin, per level.  A range lies in at most four bins of its level.
ROW_LEVELS, COLUMN_LEVELS = (32, 4096, 1 << 31), (16, 1 << 31)
BOUNDS = ("low_row", "high_row", "low_col", "high_col")
DEALT = 16


def writable_bounds(ranges: DataFrame, cards: DataFrame | None = None, range_col: str = "cell_range") -> DataFrame:
    """The writable surface as corners: ``(workbook, sheet_name, low_row, high_row, low_col, high_col)``.

    Ranges are ``A1:B9`` or single cells, in either case; a whole sheet is one
    row.  ``cards`` add their own cells.
    """
    upper = F.upper(F.col(range_col))
    paired = F.when(F.contains(upper, F.lit(":")), upper).otherwise(F.concat_ws(":", upper, upper))
    found = range_bounds(ranges.select("workbook", "sheet_name", paired.alias("cell_range")).distinct())
    found = found.select("workbook", "sheet_name", *BOUNDS)
    if cards is None:
        return found
    row, col = F.col("row_num"), F.col("col_num")
    return found.union(cards.select("workbook", "sheet_name", row, row, col, col)).distinct()


def _level(size: Column, levels: tuple[int, ...]) -> Column:
    """The first level whose bins are at least as large."""
    found = F.lit(len(levels) - 1)
    for number in reversed(range(len(levels) - 1)):
        found = F.when(size <= levels[number], F.lit(number)).otherwise(found)
    return found


def outside(cells: DataFrame, bounds: DataFrame, row: str = "at_row", column: str = "at_col") -> DataFrame:
    """The rows of ``cells(workbook, sheet_name, row, column, ...)`` that no rectangle of their sheet holds.

    An interval join in bins: a rectangle goes to the bins it touches on the
    level of its own size, four at most, and a cell looks into its one bin of
    each level, so that only rectangles near it are compared and none is
    expanded to cells.  On levels without bounds in one direction a sheet is
    few bins; there rectangles are repeated and cells dealt out over 16 parts,
    so that no sheet is one task.  Cells without a place are outside.
    """
    sheet = ["workbook", "sheet_name"]
    height, width = F.col("high_row") - F.col("low_row") + 1, F.col("high_col") - F.col("low_col") + 1
    size_of = lambda level, levels: F.element_at(F.array(*[F.lit(n).cast("long") for n in levels]), level + 1)
    bin_of = lambda at, level, levels: F.floor(F.col(at) / size_of(level, levels)).cast("int")
    span = lambda low, high, level, levels: F.explode(F.sequence(bin_of(low, level, levels), bin_of(high, level, levels)))
    row_level, column_level = F.col("row_level"), F.col("column_level")
    coarse = row_level == len(ROW_LEVELS) - 1
    dealt = (
        bounds.select(*sheet, *BOUNDS)
        .withColumn("row_level", _level(height, ROW_LEVELS)).withColumn("column_level", _level(width, COLUMN_LEVELS))
        .withColumn("row_bin", span("low_row", "high_row", row_level, ROW_LEVELS))
        .withColumn("column_bin", span("low_col", "high_col", column_level, COLUMN_LEVELS))
        .withColumn("part", F.explode(F.when(coarse, F.sequence(F.lit(0), F.lit(DEALT - 1))).otherwise(F.array(F.lit(0)))))
    )
    levels = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(len(ROW_LEVELS)) for c in range(len(COLUMN_LEVELS))])
    places = cells.select(*sheet, F.col(row).alias("at_row"), F.col(column).alias("at_col")).where("at_row IS NOT NULL AND at_col IS NOT NULL")
    looked = (
        places.select("*", F.explode(levels).alias("level")).select("*", F.col("level.r").alias("row_level"), F.col("level.c").alias("column_level"))
        .withColumn("row_bin", bin_of("at_row", row_level, ROW_LEVELS)).withColumn("column_bin", bin_of("at_col", column_level, COLUMN_LEVELS))
        .withColumn("part", F.when(coarse, F.pmod(F.xxhash64("at_row", "at_col"), F.lit(DEALT)).cast("int")).otherwise(F.lit(0)))
        .drop("level")
    )
    keys = [*sheet, "row_level", "column_level", "row_bin", "column_bin", "part"]
    a, b = looked.alias("a"), dealt.alias("b")
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    within = F.col("a.at_row").between(F.col("b.low_row"), F.col("b.high_row")) & F.col("a.at_col").between(F.col("b.low_col"), F.col("b.high_col"))
    held = a.join(b, same & within, "left_semi").select(*sheet, F.col("at_row").alias(row), F.col("at_col").alias(column)).distinct()
    return cells.join(held, [*sheet, row, column], "left_anti")


def surface_violations(updates: DataFrame, primary: DataFrame, cards: DataFrame) -> DataFrame:
    """Updates off the surface: ``(workbook, sheet_name, cell_ref, seq, code, detail)``.

    ``primary(workbook, sheet_name, cell_range)`` and the workbook's own card
    cells may be written.  Ranges stay bounds: a whole-sheet range is one row.
    Each written cell is looked at once: an update is as right or wrong as its
    cell, and the first update of a cell is the one to report.
    """
    ref = F.col("cell_ref") if "cell_ref" in updates.columns else cell_ref(F.col("row_num"), F.col("col_num"))
    written = (
        updates.groupBy("workbook", "sheet_name", ref.alias("cell_ref")).agg(F.min("seq").alias("seq"))
        .withColumn("at_row", ref_row(F.col("cell_ref"))).withColumn("at_col", ref_column(F.col("cell_ref")))
    )
    sheet = ["workbook", "sheet_name"]
    bounds = range_bounds(primary.select(*sheet, "cell_range").distinct())
    own = cards.select(*sheet, F.col("row_num").alias("at_row"), F.col("col_num").alias("at_col")).distinct()
    w, b = written.alias("w"), bounds.alias("b")
    inside = (
        (F.col("w.workbook") == F.col("b.workbook")) & (F.col("w.sheet_name") == F.col("b.sheet_name"))
        & F.col("w.at_row").between(F.col("b.low_row"), F.col("b.high_row"))
        & F.col("w.at_col").between(F.col("b.low_col"), F.col("b.high_col"))
    )
    off = w.join(b, inside, "left_anti").join(own, [*sheet, "at_row", "at_col"], "left_anti")
    sheets = bounds.select(*sheet).union(own.select(*sheet)).distinct().withColumn("known", F.lit(True))
    judged = off.join(sheets, sheet, "left")
    known = F.col("known").isNotNull()
    return judged.select(
        "workbook", "sheet_name", "cell_ref", "seq",
        F.when(known, F.lit("unsupported_write_cell")).otherwise(F.lit("unsupported_write_sheet")).alias("code"),
        F.when(known, F.concat(F.lit("write targets unsupported cell "), "sheet_name", F.lit("!"), "cell_ref"))
        .otherwise(F.concat(F.lit("write targets unsupported sheet "), "sheet_name"))
        .alias("detail"),
    )


def first_violation(violations: DataFrame) -> DataFrame:
    """The violation of the earliest update of each workbook."""
    return (
        violations.groupBy("workbook")
        .agg(F.min_by(F.struct("code", "detail"), "seq").alias("first"))
        .select("workbook", "first.code", "first.detail")
    )


def writer_decisions(checks: DataFrame, violations: DataFrame) -> DataFrame:
    """Which writer each workbook gets; the contract check comes before the surface check."""
    first = first_violation(violations).select(
        "workbook", F.col("code").alias("w_code"), F.col("detail").alias("w_detail")
    )
    both = checks.join(first, "workbook", "left")
    ok = F.col("code").isNull() & F.col("w_code").isNull()
    return both.select(
        "workbook",
        F.when(ok, F.lit(PRIMARY_WRITER)).otherwise(F.lit(NO_WRITER)).alias("writer"),
        F.lit(POLICY).alias("policy"),
        ok.alias("supported"),
        F.coalesce("code", "w_code").alias("reason_code"),
        F.coalesce("detail", "w_detail").alias("detail"),
    )


def runtime_contracts(contracts: DataFrame, prints: DataFrame) -> DataFrame:
    """Each workbook's contract with its states and card targets replaced by its own."""
    base = contracts.drop("state_variants", "card_variants")
    own = prints.select(
        "workbook", "family",
        F.array("sheet_states").alias("state_variants"),
        F.array("card_targets").alias("card_variants"),
    )
    return own.join(base, "family")


def supported_only(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of supported workbooks; nothing is written for the others."""
    return df.join(decisions.filter("supported").select("workbook"), "workbook", "left_semi")


def rejects(decisions: DataFrame) -> DataFrame:
    return decisions.filter(~F.col("supported")).select("workbook", "policy", "reason_code", "detail")


def require_supported(decisions: DataFrame) -> DataFrame:
    """Strict form: the first unsupported workbook fails the job."""
    message = F.concat_ws(": ", F.concat_ws(":", "policy", "reason_code"), "detail")
    return decisions.withColumn(
        "supported", F.when(F.col("supported"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )
