"""Whole jobs: classify workbooks, validate an output, summarise benchmark runs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.rules import classify_general
from tagloom.functions.bind import evaluate_once
from tagloom.operators import benchmarks, contract, diff, grid, tiers
from tagloom.operators.grid import CardRules, TargetRules
from tagloom.operators.lineage import Stage, cut_lineage
from tagloom.sources import packages, xml_tree


class Batch(NamedTuple):
    """Tables of one classification run."""

    results: DataFrame
    cards: DataFrame
    updates: DataFrame
    summary: DataFrame
    cells: DataFrame


def rule_results(targets: DataFrame) -> DataFrame:
    """Targets labelled by the rules alone: ``(workbook, row_num, link, category, method)``."""
    labelled = evaluate_once(targets, "category", classify_general(F.col("title")))
    return labelled.select("workbook", "row_num", "link", "category", F.lit("rule").alias("method"))


def classify_grids(
    cells: DataFrame,
    pages: DataFrame,
    scorers: tiers.Scorers,
    stage: tiers.Stage = cut_lineage,
    target_rules: TargetRules = TargetRules(),
    card_rules: CardRules = CardRules(),
) -> Batch:
    """Label every target of every workbook and write the labels into the grid.

    Cells and results are staged: packages are read once and each model is
    called once however many of the tables are used.
    """
    cells = stage(cells)
    targets = grid.target_rows(cells, target_rules)
    results = tiers.resolve_categories(targets, pages, scorers, stage=stage)
    cards = grid.card_cells(cells, card_rules)
    updates = grid.winning_updates(results, cards, target_rules)
    written = grid.upsert(cells, updates, grid.writable_places(card_rules, target_rules))
    return Batch(results, cards, updates, grid.category_summary(results), written)


def decide_writers(
    cells: DataFrame,
    sheets: DataFrame,
    workbooks: DataFrame,
    contracts: DataFrame,
    updates: DataFrame,
    unreadable: DataFrame | None = None,
    stage: tiers.Stage = cut_lineage,
) -> DataFrame:
    """Contract and surface checks of each workbook, first failure reported.

    Cards are found by the rules of each workbook's contract, once.
    """
    rules = contract.contract_card_rules(workbooks, contracts)
    cards = stage(grid.card_cells(cells, rules, skip_final=False))
    prints = contract.fingerprints(sheets, workbooks, contract.card_targets(cards, sheets))
    checks = contract.check_contracts(prints, contracts, unreadable)
    primary = workbooks.join(contracts, "family").select(
        "workbook", F.col("target_sheet").alias("sheet_name"), F.explode("allowed_ranges").alias("cell_range")
    )
    return contract.writer_decisions(checks, contract.surface_violations(updates, primary, cards))


class Snapshot(NamedTuple):
    """What a package comparison looks at; sheets are compared by ``nodes``, or by ``cells`` where there are no parts."""

    parts: DataFrame
    sheets: DataFrame
    names: DataFrame
    merges: DataFrame
    cells: DataFrame | None = None
    contents: DataFrame | None = None


def snapshot(parts: DataFrame) -> Snapshot:
    """Tables of all packages in ``parts``."""
    sheets = packages.sheet_catalogue(parts)
    whole = parts.filter("content IS NOT NULL")
    return Snapshot(
        whole.select("workbook", "part", "sha256"), sheets, packages.defined_names(parts), packages.merges(parts, sheets),
        contents=whole.select("workbook", "part", "content"),
    )


def book_errors(template: Snapshot, output: Snapshot) -> DataFrame:
    """Errors of whole workbooks: ``(workbook, errors)``; everything known of a workbook meets in one shuffle.

    The arrays hold the sheets, names or parts of one file.
    """
    none = lambda kind: F.lit(None).cast(kind)
    sheet, name = "struct<sheet_idx: int, sheet_name: string, state: string, part: string>", "struct<name: string, local_sheet_id: int, text: string>"

    def facts(side: Snapshot, tag: str) -> DataFrame:
        counts = diff.object_counts(side.parts)
        of_sheets = F.struct(F.col("sheet_idx").cast("int").alias("sheet_idx"), "sheet_name", "state", "part").cast(sheet)
        rows = side.sheets.select("workbook", of_sheets.alias("sheet"), none(name).alias("named"), none("long").alias("media"), none("long").alias("drawings"))
        rows = rows.union(side.names.select("workbook", none(sheet), F.struct("name", "local_sheet_id", "text").cast(name), none("long"), none("long")))
        rows = rows.union(counts.select("workbook", none(sheet), none(name), "media_count", "drawing_count"))
        return rows.withColumn("side", F.lit(tag))

    def listed(tag: str, column: str, fields: tuple[str, ...]) -> Column:
        own = F.when((F.col("side") == tag) & F.col(column).isNotNull(), F.struct(*[F.col(f"{column}.{f}") for f in fields]))
        return F.array_sort(F.collect_list(own))

    kinds = {
        "sheet_order": ("sheet", ("sheet_idx", "sheet_name")), "sheet_states": ("sheet", ("sheet_name", "state")),
        "relationship_targets": ("sheet", ("sheet_name", "part")), "defined_names": ("named", ("name", "local_sheet_id", "text")),
    }
    counted = {"media_count": "media", "drawing_count": "drawings"}
    both = facts(template, "l").union(facts(output, "r")).groupBy("workbook").agg(
        *[listed(tag, column, fields).alias(f"{kind}_{tag}") for kind, (column, fields) in kinds.items() for tag in "lr"],
        *[F.max(F.when(F.col("side") == tag, F.col(column))).alias(f"{kind}_{tag}") for kind, column in counted.items() for tag in "lr"],
    )
    shown = lambda kind, tag: F.col(f"{kind}_{tag}")["sheet_name"] if kind == "sheet_order" else F.col(f"{kind}_{tag}")
    differs = [F.when(~shown(kind, "l").eqNullSafe(shown(kind, "r")), diff.error(kind)) for kind in (*kinds, *counted)]
    return both.select("workbook", F.array_compact(F.array(*differs)).alias("errors"))


def package_errors(
    template: Snapshot,
    output: Snapshot,
    surface: DataFrame,
    allowlist: diff.Allowlist = diff.Allowlist(),
    stage: Stage = cut_lineage,
) -> DataFrame:
    """All violations of the package invariants: ``(workbook, error_kind, item)``.

    ``surface`` are the writable rectangles, ``contract.writable_bounds``.  If
    the allowlist includes them, their sheets may change, but only there; the
    sheets that it names may change freely.

    Each kind of key is compared once, and each comparison yields all its
    errors as an array: parts, whole workbooks, merges of a sheet, and the
    elements (or cells) of writable sheets whose part changed.
    """
    key = ["workbook", "sheet_name"]
    # small tables that several comparisons use: worked out once each
    template, output = (side._replace(sheets=stage(side.sheets)) for side in (template, output))
    surface = stage(surface)
    writable_sheets = surface.select(*key).distinct()
    allowed = diff.allowed_parts(allowlist, template.sheets, writable_sheets)
    changes = stage(diff.part_changes(template.parts, output.parts).filter("status <> 'equal'"))
    of_parts = diff.part_errors(changes, allowed, allowlist.parts, allowlist.prefixes, allowlist.patterns)

    changed = changes.filter("status = 'changed'").select("workbook", "part")
    in_changed = stage(template.sheets.join(changed, ["workbook", "part"], "left_semi").select(*key, "part").join(writable_sheets, key, "left_semi"))
    if template.contents is not None and output.contents is not None:
        nodes = lambda side: xml_tree.sheet_nodes(side.contents, in_changed)
        found = diff.tree_drift(nodes(template), nodes(output), surface, stage)
        in_cell = F.col("anchor").isNotNull()
        kind = F.when(in_cell, "drift").otherwise("sheet_drift")
        drift = found.select("workbook", kind.alias("error_kind"), F.concat_ws("!", "sheet_name", F.coalesce("anchor", "path")).alias("item")).distinct()
    else:
        grid_of = lambda side: side.cells.join(in_changed, key, "left_semi")
        found = diff.cell_drift(grid_of(template), grid_of(output), surface)
        drift = found.select("workbook", F.lit("drift").alias("error_kind"), F.concat_ws("!", "sheet_name", "cell_ref").alias("item"))

    tagged = lambda side, tag: side.merges.select(*key, "merges", F.lit(tag).alias("side"))
    of_side = lambda tag: F.max(F.when(F.col("side") == tag, F.struct("merges")))
    of_merges = tagged(template, "l").union(tagged(output, "r")).groupBy(*key).agg(of_side("l").alias("l"), of_side("r").alias("r")).filter(
        ~F.col("l").eqNullSafe(F.col("r"))
    ).select("workbook", F.array(diff.error("merges", F.col("sheet_name"))).alias("errors"))

    errors = of_parts.union(book_errors(template, output)).union(of_merges)
    return errors.select("workbook", F.inline("errors")).union(drift)


def benchmark_summary(
    runs: DataFrame, candidate: str = "primary", baseline: str = "legacy", justification: str | None = None
) -> DataFrame:
    """Comparison of two writers by median output stage, with the guardrail verdict."""
    medians = benchmarks.median_metrics(benchmarks.run_metrics(runs))
    comparison = benchmarks.compare_writers(medians, candidate, baseline)
    return benchmarks.guardrail(comparison, F.lit(justification).cast("string"))
