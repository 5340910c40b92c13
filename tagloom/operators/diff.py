"""Differences between two package snapshots, two file listings and two grids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.refs import ref_column, ref_row
from tagloom.operators.contract import outside
from tagloom.operators.lineage import Stage, cut_lineage

PART_KEY = ["workbook", "part"]


def part_changes(template: DataFrame, output: DataFrame, keys: list[str] = PART_KEY) -> DataFrame:
    """Status of every part: ``added``, ``removed``, ``changed`` or ``equal``."""
    left = template.select(*keys, F.col("sha256").alias("l_hash"), F.lit(True).alias("l"))
    right = output.select(*keys, F.col("sha256").alias("r_hash"), F.lit(True).alias("r"))
    status = (
        F.when(F.col("l").isNull(), "added")
        .when(F.col("r").isNull(), "removed")
        .when(F.col("l_hash") != F.col("r_hash"), "changed")
        .otherwise("equal")
    )
    return left.join(right, keys, "full_outer").select(*keys, status.alias("status"))


def store_snapshot(snapshot: DataFrame, table: str, keys: list[str] = PART_KEY, buckets: int = 64) -> DataFrame:
    """Keep a snapshot as a table that is dealt out and sorted by its keys, for comparisons to come.

    ``part_changes`` and ``new_evidence`` against it then shuffle the other
    side alone.  Rows are dealt out before they are written, so that each
    bucket is one file.  An existing table is not replaced.
    """
    dealt = snapshot.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode("errorifexists").saveAsTable(table)
    return snapshot.sparkSession.table(table)


def only_in(left: DataFrame, right: DataFrame, keys: list[str] = PART_KEY) -> DataFrame:
    return left.select(*keys).join(right.select(*keys), keys, "left_anti")


def in_both_but_changed(left: DataFrame, right: DataFrame, keys: list[str] = PART_KEY) -> DataFrame:
    other = right.select(*keys, F.col("sha256").alias("r_hash"))
    return left.join(other, keys).filter(F.col("sha256") != F.col("r_hash")).select(*keys)


def allowed_by_name(
    part: Column, exact: Sequence[str] = (), prefixes: Sequence[str] = (), patterns: Sequence[str] = ()
) -> Column:
    """Whether an allowlist names the part: exactly, by prefix, or by a pattern that fits all of it."""
    hit = part.isin(*exact) if exact else F.lit(False)
    for prefix in prefixes:
        hit = hit | part.startswith(prefix)
    for pattern in patterns:
        hit = hit | part.rlike(f"^(?:{pattern})\\z")
    return hit


def sheet_parts(sheet_names: DataFrame, sheets: DataFrame) -> DataFrame:
    """Parts of named sheets; a name the workbook lacks fails the job."""
    parts = sheets.select("workbook", "sheet_name", "part")
    found = sheet_names.join(parts, ["workbook", "sheet_name"], "left")
    unknown = F.raise_error(F.concat(F.lit("allowlist references unknown sheet name: "), "sheet_name"))
    return found.select("workbook", F.when(F.col("part").isNotNull(), F.col("part")).otherwise(unknown).alias("part"))


@dataclass(frozen=True)
class Allowlist:
    """What may change in a package: parts by name, prefix or pattern, sheets by name, and writable sheets if included."""

    parts: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    sheet_names: tuple[str, ...] = ()
    include_writable: bool = False
    contract_path: str | None = None


def compiled_allowlist(settings: DataFrame) -> Allowlist:
    """The allowlist of a settings table with one row, as ``read_allowlist`` gives it; two rows are refused."""
    rows = settings.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("an allowlist has exactly one settings row")
    row = rows[0]
    listed = lambda name: tuple(v for v in row[name] or () if v)
    return Allowlist(
        listed("allowed_changed_parts"), listed("allowed_changed_part_prefixes"), listed("allowed_changed_part_patterns"),
        listed("allowed_changed_sheet_names"), bool(row["include_contract_writable_surface_sheet_xml"]), row["contract_path"],
    )


def allowed_parts(allowlist: Allowlist, sheets: DataFrame, writable_sheets: DataFrame) -> DataFrame:
    """Sheet parts that the allowlist lets change: ``(workbook, part)``; a sheet that a workbook lacks fails the job."""
    named = sheets.select("workbook").distinct().select(
        "workbook", F.explode(F.array(*map(F.lit, allowlist.sheet_names)).cast("array<string>")).alias("sheet_name")
    )
    if allowlist.include_writable:
        named = named.unionByName(writable_sheets.select("workbook", "sheet_name"))
    return sheet_parts(named.distinct(), sheets)


def unexpected_changes(
    changes: DataFrame,
    allowed_parts: DataFrame,
    exact: Sequence[str] = (),
    prefixes: Sequence[str] = (),
    patterns: Sequence[str] = (),
) -> DataFrame:
    """Changed parts that neither the name rules nor ``allowed_parts(workbook, part)`` allow."""
    named = allowed_by_name(F.col("part"), exact, prefixes, patterns)
    changed = changes.filter((F.col("status") == "changed") & ~named).select(*PART_KEY)
    return changed.join(allowed_parts, PART_KEY, "left_anti")


def cell_drift(template: DataFrame, output: DataFrame, surface: DataFrame) -> DataFrame:
    """Cells of two grids that differ by more than an approved value: ``(workbook, sheet_name, cell_ref)``.

    Of a writable cell the presence, the formula, the style and whether it
    carries a type are compared; of any other cell everything.  Grids have
    ``cell_ref``, ``value``, ``cell_type`` and ``has_formula``, and ``formula``
    and ``style`` where they know them.  ``surface`` are corners, as
    ``contract.writable_bounds`` gives them; only cells whose value or type
    changed are looked up there.
    """
    more = [c for c in ("formula", "style") if c in template.columns and c in output.columns]
    key = ["workbook", "sheet_name", "cell_ref"]
    upper = F.upper(F.col("cell_ref")).alias("cell_ref")

    def side(cells: DataFrame, tag: str) -> DataFrame:
        columns = ("value", "cell_type", "has_formula", *more)
        return cells.select(
            "workbook", "sheet_name", upper,
            *[F.col(c).alias(f"{tag}_{c}") for c in columns], F.lit(True).alias(tag),
        )

    both = side(template, "l").join(side(output, "r"), key, "full_outer")
    same = lambda c: F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    same_text = F.coalesce("l_value", F.lit("")).eqNullSafe(F.coalesce("r_value", F.lit("")))
    same_typed = F.col("l_cell_type").isNull() == F.col("r_cell_type").isNull()
    frame = F.col("l").isNotNull() & F.col("r").isNotNull() & same("has_formula") & same_typed
    for column in more:
        frame = frame & same(column)
    changed = both.select(*key, (~frame).alias("certain"), (same_text & same("cell_type")).alias("equal")).filter("certain OR NOT equal")
    return _off_surface(changed.select(*key, "certain"), "cell_ref", surface).select(*key)


def _off_surface(changed: DataFrame, ref: str, surface: DataFrame) -> DataFrame:
    """Changes that are certain, and those of cells that may not be written."""
    asked = changed.filter(~F.col("certain")).withColumn("at_row", ref_row(F.col(ref))).withColumn("at_col", ref_column(F.col(ref)))
    return changed.filter("certain").union(outside(asked, surface).select(*changed.columns))


NODE_KEY = ["workbook", "sheet_name", "path"]


def tree_drift(template: DataFrame, output: DataFrame, surface: DataFrame, stage: Stage = cut_lineage) -> DataFrame:
    """Elements of two sheets that differ by more than approved values: ``(workbook, sheet_name, path, anchor, change)``.

    Sides are ``xml_tree.shred`` rows.  Of a cell on the surface the frame is
    compared: its attributes, but for the value of ``t`` if it has one, its
    text, and its children without the payload; of everything else all.
    ``change`` says what: ``added``, ``removed``, ``name``, ``attributes``,
    ``text``, ``tail`` or ``order``.  Of what is added or removed as a whole
    only the top element is listed, and an element's order only where its
    children are the same ones.
    """
    values = ("name", "attributes", "text", "tail", "children", "frame", "payload", "anchor", "parent")

    def side(nodes: DataFrame, tag: str) -> DataFrame:
        return nodes.select(*NODE_KEY, F.struct(*values).alias(tag))

    both = side(template, "l").join(side(output, "r"), NODE_KEY, "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")))
    either = lambda name: F.coalesce(f"l.{name}", f"r.{name}")
    differs = lambda name: ~F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    untyped = lambda tag: F.transform(
        f"{tag}.attributes", lambda a: F.when(a["name"] == "t", F.struct(a["name"].alias("name"), F.lit("*").alias("value"))).otherwise(a)
    )
    change = F.when(F.col("l").isNull(), "added").when(F.col("r").isNull(), "removed")
    for name in ("name", "attributes", "text", "tail"):
        change = change.when(differs(name), name)
    change = change.when(differs("children"), "order")
    is_cell = F.element_at(F.split(either("parent"), "/"), -1).startswith("row[")
    framed = F.col("l").isNull() | F.col("r").isNull() | differs("name") | (~untyped("l").eqNullSafe(untyped("r"))) | differs("text") | differs("tail") | differs("frame")
    certain = either("anchor").isNull() | (~either("payload") & F.when(is_cell, framed).otherwise(F.lit(True)))
    rows = both.select(*NODE_KEY, either("parent").alias("parent"), either("anchor").alias("anchor"), change.alias("change"), certain.alias("certain"))
    found = stage(_off_surface(rows.filter("change IS NOT NULL"), "anchor", surface).drop("certain"))
    moved = F.col("change").isin("added", "removed")
    one_sided = found.filter(moved)
    above = one_sided.select("workbook", "sheet_name", F.col("path").alias("parent"))
    inside = ["workbook", "sheet_name", "parent"]
    tops = one_sided.join(above, inside, "left_anti")
    held = found.filter(~moved & (F.col("change") != "order"))
    ordered = found.filter("change = 'order'").join(
        one_sided.select("workbook", "sheet_name", F.col("parent").alias("path")).distinct(), NODE_KEY, "left_anti"
    )
    columns = [*NODE_KEY, "anchor", "change"]
    return tops.select(*columns).union(held.select(*columns)).union(ordered.select(*columns))


def changed_values(
    template: DataFrame, output: DataFrame, column: str, keys: list[str]
) -> DataFrame:
    """Keys whose ``column`` differs or that only one side has."""
    left = template.select(*keys, F.col(column).alias("l"), F.lit(True).alias("in_l"))
    right = output.select(*keys, F.col(column).alias("r"), F.lit(True).alias("in_r"))
    both = left.join(right, keys, "full_outer")
    differs = ~F.col("l").eqNullSafe(F.col("r")) | ~F.col("in_l").eqNullSafe(F.col("in_r"))
    return both.filter(differs).select(*keys)


def object_counts(parts: DataFrame) -> DataFrame:
    """Media and drawing parts per workbook."""
    return parts.groupBy("workbook").agg(
        F.count_if(F.col("part").startswith("xl/media/")).alias("media_count"),
        F.count_if(F.col("part").startswith("xl/drawings/")).alias("drawing_count"),
    )


def error(kind: str, item: Column | None = None) -> Column:
    """An entry of the report: ``struct<error_kind, item>``."""
    return F.struct(F.lit(kind).alias("error_kind"), (F.lit("") if item is None else item.cast("string")).alias("item"))


def part_errors(
    changes: DataFrame, allowed_parts: DataFrame, exact: Sequence[str] = (), prefixes: Sequence[str] = (), patterns: Sequence[str] = ()
) -> DataFrame:
    """Errors of parts that are new, gone or changed without leave: ``(workbook, errors)``."""
    part, status = F.col("part"), F.col("status")
    listed = changes.join(allowed_parts.distinct().withColumn("free", F.lit(True)), PART_KEY, "left")
    free = F.col("free").isNotNull() | allowed_by_name(part, exact, prefixes, patterns)
    found = [
        F.when(status == "added", error("unexpected_added", part)), F.when(status == "removed", error("unexpected_removed", part)),
        F.when((status == "changed") & ~free, error("unexpected_changed", part)),
    ]
    return listed.select("workbook", F.array_compact(F.array(*found)).alias("errors"))


def error_report(items: DataFrame) -> DataFrame:
    """Items nested per workbook and kind, sorted; bounded by the parts and cells of one file."""
    return items.groupBy("workbook", "error_kind").agg(
        F.array_sort(F.collect_set(F.when(F.col("item") != "", F.col("item")))).alias("items")
    )


# --- file listings -------------------------------------------------------------------


def new_evidence(before: DataFrame, after: DataFrame, since: Column, keys: list[str] = ["path"]) -> DataFrame:
    """Files that are new, newer or of another length, and written at or after ``since``.

    Listings are ``(path, modified, length)``; ``since`` may be a column of ``after``.
    """
    old = before.select(*keys, F.col("modified").alias("old_modified"), F.col("length").alias("old_length"))
    touched = (
        F.col("old_modified").isNull()
        | (F.col("modified") > F.col("old_modified"))
        | (F.col("length") != F.col("old_length"))
    )
    return after.join(old, keys, "left").filter(touched & (F.col("modified") >= since)).select(*keys).distinct()


def gate_verdict(evidence: Column, normal_open: Column, repair_open: Column) -> tuple[Column, Column]:
    """(repair detected, passed) from the number of evidence files and the two open attempts."""
    repair = (evidence > 0) | (~normal_open & repair_open)
    return repair, ~repair & normal_open
