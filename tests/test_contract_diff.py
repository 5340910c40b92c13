import random
import statistics

import pytest
from pyspark.sql import functions as F

from tagloom.operators import benchmarks, contract, diff
from tagloom.operators.contract import TARGET_ENTRY

WRITE = "workbook string, sheet_name string, cell_ref string, seq int"
SURFACE = "workbook string, sheet_name string, cell_ref string"


def test_expand_ranges(spark):
    rows = spark.createDataFrame([("A1:B2",), ("C3:C3",), ("B9:A9",), ("A9:A8",), ("Z1:AA1",)], "cell_range string")
    got = sorted((r.cell_range, r.cell_ref) for r in contract.expand_ranges(rows).collect())
    assert got == [("A1:B2", c) for c in ("A1", "A2", "B1", "B2")] + [("C3:C3", "C3"), ("Z1:AA1", "AA1"), ("Z1:AA1", "Z1")]
    with pytest.raises(Exception, match="invalid cell reference"):
        contract.expand_ranges(spark.createDataFrame([("A1:x",)], "cell_range string")).collect()


def test_violations_and_first(spark):
    primary = spark.createDataFrame([("w", "2026 list", "G5:G9"), ("u", "S", "A1:XFD1048576")], "workbook string, sheet_name string, cell_range string")
    cards = spark.createDataFrame([("w", "IB", 5, 3)], "workbook string, sheet_name string, row_num int, col_num int")
    writes = spark.createDataFrame(
        [("w", "2026 list", "G5", 1), ("w", "2026 list", "H5", 3), ("w", "XX", "A1", 2), ("w", "IB", "C5", 4), ("v", "2026 list", "G5", 1),
         ("u", "S", "ZZ99999", 1)], WRITE)
    found = contract.surface_violations(writes, primary, cards)
    assert {(r.workbook, r.sheet_name, r.cell_ref, r.code) for r in found.collect()} == {
        ("w", "2026 list", "H5", "unsupported_write_cell"), ("w", "XX", "A1", "unsupported_write_sheet"),
        ("v", "2026 list", "G5", "unsupported_write_sheet")}
    first = {r.workbook: (r.code, r.detail) for r in contract.first_violation(found).collect()}
    assert first["w"] == ("unsupported_write_sheet", "write targets unsupported sheet XX")


CONTRACT = dict(
    family="f", sheet_count=2, sheet_order=["2026 list", "IB"], target_sheet="2026 list", allowed_ranges=["G5:G220"],
    state_variants=[[("2026 list", "visible"), ("IB", "hidden")]], card_variants=[[("IB", ["C5"])]], hashes=["h"],
)
PRINT = dict(
    workbook="w", family="f", workbook_xml_sha256="h", sheet_order=["2026 list", "IB"],
    sheet_states=[("2026 list", "visible"), ("IB", "hidden")], card_targets=[("IB", ["C5"])],
)
CHECKS = [
    ({}, {}, None),
    (dict(sheet_order=["2026 list"]), {}, "unsupported_sheet_count"),
    (dict(sheet_states=[("IB", "hidden"), ("list", "visible")], sheet_order=["list", "IB"]), {}, "unsupported_missing_target_sheet"),
    (dict(sheet_order=["IB", "2026 list"]), {}, "unsupported_sheet_order"),
    (dict(sheet_states=[("2026 list", "visible"), ("IB", "visible")]), {}, "unsupported_sheet_state"),
    (dict(sheet_states=[("2026 list", "visible"), ("IB", "visible")]), dict(state_variants=[]), None),
    (dict(card_targets=[]), {}, "unsupported_missing_linked_card_layout"),
    (dict(card_targets=[("IB", ["C5", "I5"])]), dict(card_variants=[[("IB", ["C5"])], [("IB", ["C5", "I5"])]]), None),
    (dict(card_targets=[]), dict(card_variants=[]), None),
    (dict(workbook_xml_sha256="x"), {}, "unsupported_workbook_family_signature"),
    (dict(workbook_xml_sha256="x"), dict(hashes=[]), None),
]
PRINT_SCHEMA = f"workbook string, family string, workbook_xml_sha256 string, sheet_order array<string>, sheet_states array<struct<key:string,value:string>>, card_targets {TARGET_ENTRY}"
CONTRACT_SCHEMA = f"family string, sheet_count int, sheet_order array<string>, target_sheet string, allowed_ranges array<string>, state_variants array<array<struct<key:string,value:string>>>, card_variants array<{TARGET_ENTRY}>, hashes array<string>"


def test_contract_checks_and_decisions(spark):
    prints = [{**PRINT, **p, "workbook": f"w{i}", "family": f"f{i}"} for i, (p, _, _) in enumerate(CHECKS)]
    contracts = [{**CONTRACT, **c, "family": f"f{i}"} for i, (_, c, _) in enumerate(CHECKS)]
    frame = lambda rows, schema: spark.createDataFrame(
        [tuple(r[f.split()[0]] for f in names(schema)) for r in rows], schema)
    names = lambda schema: [f.name for f in spark.createDataFrame([], schema).schema]
    checks = contract.check_contracts(frame(prints, PRINT_SCHEMA), frame(contracts, CONTRACT_SCHEMA))
    got = {r.workbook: r.code for r in checks.collect()}
    assert got == {f"w{i}": code for i, (_, _, code) in enumerate(CHECKS)}
    bad = spark.createDataFrame([("w0", "2026 list", "H5", 1, "unsupported_write_cell", "2026 list!H5")], WRITE + ", code string, detail string")
    decisions = contract.writer_decisions(checks, bad)
    rows = {r.workbook: r for r in decisions.collect()}
    assert (rows["w0"].supported, rows["w0"].reason_code) == (False, "unsupported_write_cell")
    assert (rows["w5"].supported, rows["w5"].writer, rows["w5"].reason_code) == (True, "primary_template_value_only", None)
    assert all(r.policy == "hard_fail" for r in rows.values())
    updates = spark.createDataFrame([("w0", 1), ("w5", 2)], "workbook string, n int")
    assert [r.workbook for r in contract.supported_only(updates, decisions).collect()] == ["w5"]
    assert contract.rejects(decisions).count() == sum(not r.supported for r in rows.values())
    with pytest.raises(Exception, match="hard_fail:unsupported_write_cell"):
        contract.require_supported(decisions.filter("workbook = 'w0'")).collect()
    own = contract.runtime_contracts(frame(contracts, CONTRACT_SCHEMA), frame(prints, PRINT_SCHEMA))
    assert {r.workbook: r.card_variants[0] for r in own.collect()}["w6"] == []


def test_what_cannot_be_checked_is_not_supported(spark):
    columns = [f.name for f in spark.createDataFrame([], PRINT_SCHEMA).schema]
    rows = [{**PRINT, "workbook": "ok"}, {**PRINT, "workbook": "no family", "family": "x"}, {**PRINT, "workbook": "twice", "family": "g"},
            {**PRINT, "workbook": "no list", "sheet_order": None, "sheet_states": None}, {**PRINT, "workbook": "cut"}]
    prints = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], PRINT_SCHEMA)
    names = [f.name for f in spark.createDataFrame([], CONTRACT_SCHEMA).schema]
    contracts = spark.createDataFrame([tuple({**CONTRACT, "family": f}[c] for c in names) for f in ("f", "g", "g")], CONTRACT_SCHEMA)
    unreadable = spark.createDataFrame([("cut", "xl/workbook.xml")], "workbook string, part string")
    checks = contract.check_contracts(prints, contracts, unreadable)
    assert {r.workbook: r.code for r in checks.collect()} == {
        "ok": None, "no family": "unsupported_missing_contract", "twice": "unsupported_ambiguous_contract",
        "no list": "unsupported_missing_catalogue", "cut": "unsupported_unreadable_part"}
    none = spark.createDataFrame([], WRITE + ", code string, detail string")
    assert [r.workbook for r in contract.writer_decisions(checks, none).filter("supported").collect()] == ["ok"]


def test_state_variants_and_hashes(spark):
    df = spark.createDataFrame(
        [([{"b": "1", "a": "2"}], {"x": "y"}, "h", ["i", "h"]), ([], {"x": "y"}, "", None), (None, {}, None, ["j"])],
        "several array<map<string,string>>, single map<string,string>, one string, many array<string>")
    got = df.select(contract.state_variants(F.col("several"), F.col("single")).alias("v"),
                    contract.allowed_hashes(F.col("one"), F.col("many")).alias("h")).collect()
    assert [[[tuple(e) for e in v] for v in r.v] for r in got] == [[[("a", "2"), ("b", "1")]], [[("x", "y")]], []]
    assert [r.h for r in got] == [["h", "i"], [], ["j"]]


def test_part_changes_and_allowlist(spark):
    part = "workbook string, part string, sha256 string"
    left = spark.createDataFrame([("w", "a", "1"), ("w", "b", "1"), ("w", "xl/media/c", "1"), ("w", "d.xml", "1"), ("w", "e", "1")], part)
    right = spark.createDataFrame([("w", "a", "2"), ("w", "xl/media/c", "2"), ("w", "d.xml", "2"), ("w", "e", "1"), ("w", "f", "1")], part)
    changes = diff.part_changes(left, right)
    assert {(r.part, r.status) for r in changes.collect()} == {
        ("a", "changed"), ("b", "removed"), ("xl/media/c", "changed"), ("d.xml", "changed"), ("e", "equal"), ("f", "added")}
    allowed = spark.createDataFrame([("w", "a")], "workbook string, part string")
    none = allowed.limit(0)
    names = lambda df: {r.part for r in df.collect()}
    settings = "allowed_changed_parts array<string>, allowed_changed_part_prefixes array<string>, allowed_changed_part_patterns array<string>, allowed_changed_sheet_names array<string>, include_contract_writable_surface_sheet_xml boolean, contract_path string"
    compiled = diff.compiled_allowlist(spark.createDataFrame([(["e"], None, [r"d\.xml"], ["S"], True, None)], settings))
    assert compiled == diff.Allowlist(("e",), (), (r"d\.xml",), ("S",), True, None)
    with pytest.raises(ValueError):
        diff.compiled_allowlist(spark.createDataFrame([], settings))
    assert names(diff.unexpected_changes(changes, none)) == {"a", "xl/media/c", "d.xml"}
    assert names(diff.unexpected_changes(changes, allowed, prefixes=["xl/media/"], patterns=[r"d\.xm", "d"])) == {"d.xml"}
    assert names(diff.unexpected_changes(changes, allowed, exact=["xl/media/c"], patterns=[r"d\.xml"])) == set()
    sheets = spark.createDataFrame([("w", "S", "p.xml")], "workbook string, sheet_name string, part string")
    with pytest.raises(Exception, match="unknown sheet name: T"):
        diff.sheet_parts(spark.createDataFrame([("w", "T")], "workbook string, sheet_name string"), sheets).collect()


def test_cell_drift(spark):
    cell = "workbook string, sheet_name string, cell_ref string, value string, cell_type string, has_formula boolean"
    base = [("w", "S", "C5", "old", "s", False), ("w", "S", "D5", "x", None, False), ("w", "S", "E5", None, None, False), ("w", "S", "F5", "1", None, False)]
    after = [("w", "S", "C5", "new", "inlineStr", False), ("w", "S", "D5", "y", None, False), ("w", "S", "E5", "", None, False), ("w", "S", "G5", "1", None, False)]
    surface = contract.writable_bounds(spark.createDataFrame([("w", "S", "c5")], "workbook string, sheet_name string, cell_range string"))
    got = {r.cell_ref for r in diff.cell_drift(spark.createDataFrame(base, cell), spark.createDataFrame(after, cell), surface).collect()}
    assert got == {"D5", "F5", "G5"}
    typed = [("w", "S", "C5", "old", None, False)]
    got = diff.cell_drift(spark.createDataFrame(base[:1], cell), spark.createDataFrame(typed, cell), surface).collect()
    assert [r.cell_ref for r in got] == ["C5"]


def test_cells_outside_rectangles(spark):
    rnd = random.Random(7)
    edges = lambda most: sorted(rnd.choice([rnd.randint(1, 40), rnd.randint(1, most), most]) for _ in range(2))
    bounds = [(f"w{k % 3}", f"S{k % 2}", *edges(6000), *edges(300)) for k in range(40)]
    bounds = [b for b in bounds if b[0] != "w1"] + [("w1", "S0", 1, 1_048_576, 1, 16_384), ("w1", "S1", 1, 1_048_576, 3, 3), ("w1", "S1", 5, 5, 1, 16_384)]
    near = [(w, s, r + dr, c + dc) for w, s, r0, r1, c0, c1 in bounds for r in (r0, r1) for c in (c0, c1) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]
    cells = near + [(f"w{rnd.randrange(4)}", f"S{rnd.randrange(3)}", rnd.randint(1, 7000), rnd.randint(1, 400)) for _ in range(3000)]
    cells += [("w1", "S0", None, 4), ("w1", "S0", 4, None)]
    got = contract.outside(
        spark.createDataFrame([(*c, k) for k, c in enumerate(cells)], "workbook string, sheet_name string, at_row int, at_col int, k int"),
        spark.createDataFrame(bounds, "workbook string, sheet_name string, low_row int, high_row int, low_col int, high_col int"),
    )
    inside = lambda w, s, r, c: r is not None and c is not None and any(
        (w, s) == b[:2] and b[2] <= r <= b[3] and b[4] <= c <= b[5] for b in bounds
    )
    assert {r.k for r in got.collect()} == {k for k, c in enumerate(cells) if not inside(*c)}


def test_whole_sheets_stay_one_rectangle(spark):
    ranges = spark.createDataFrame([("w", "S", "a1:xfd1048576"), ("w", "S", "C5"), ("w", "T", "B9:A1")], "workbook string, sheet_name string, cell_range string")
    cards = spark.createDataFrame([("w", "T", 7, 3)], "workbook string, sheet_name string, row_num int, col_num int")
    got = contract.writable_bounds(ranges, cards)
    assert {tuple(r) for r in got.collect()} == {("w", "S", 1, 1048576, 1, 16384), ("w", "S", 5, 5, 3, 3), ("w", "T", 7, 7, 3, 3)}
    cells = spark.createDataFrame([("w", "S", "ZZ999999", "1", None, False)], "workbook string, sheet_name string, cell_ref string, value string, cell_type string, has_formula boolean")
    drift = diff.cell_drift(cells, cells.withColumn("value", F.lit("2")), got)
    assert drift.count() == 0 and "sequence(low_row" not in drift._jdf.queryExecution().toString().replace("#", "")


def test_new_evidence_and_verdict(spark):
    listing = "path string, modified int, length int"
    before = spark.createDataFrame([("same", 5, 1), ("newer", 5, 1), ("longer", 20, 1), ("old-change", 1, 1)], listing)
    after = spark.createDataFrame([("same", 5, 1), ("newer", 12, 1), ("longer", 20, 2), ("old-change", 3, 2), ("new", 10, 1), ("new-old", 9, 1)], listing)
    got = {r.path for r in diff.new_evidence(before, after, F.lit(10)).collect()}
    assert got == {"newer", "longer", "new"}
    runs = spark.createDataFrame([(0, True, False), (1, True, False), (0, False, True), (0, False, False)], "e int, n boolean, r boolean")
    repair, passed = diff.gate_verdict(F.col("e"), F.col("n"), F.col("r"))
    assert [tuple(r) for r in runs.select(repair, passed).collect()] == [(False, True), (True, False), (True, False), (False, False)]


# --- benchmark summaries ---------------------------------------------------------------------


@pytest.mark.parametrize("last_values", [20, 100, 20_000])
def test_exact_median(spark, last_values):
    rnd = random.Random(last_values)
    groups = {
        "one": [3.5], "two": [1.0, 4.0], "same": [2.0] * 999, "ties": [1.0] * 500 + [2.0] * 500,
        "normal": [rnd.gauss(0, 1) for _ in range(5001)], "tail": [rnd.random() ** -3 for _ in range(4000)],
        "few": [float(rnd.randint(0, 5)) for _ in range(3000)], "edge": [-1e300, 0.0, 1e300, 5e-324],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    got = {r.k: r.median for r in benchmarks.exact_median(df, ["k"], "v", last_values=last_values).collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def run_rows(writer, write, save):
    return (writer, 1.0, 0.2, 1.0, write, save, 5.0)


def test_benchmark_summary(spark):
    from tagloom.plans.jobs import benchmark_summary

    schema = "writer string, load_seconds double, manifest_build_seconds double, classify_seconds double, write_seconds double, save_seconds double, total_seconds double"
    runs = spark.createDataFrame([run_rows("primary", 2.0, 1.0), run_rows("legacy", 9.0, 3.0)], schema)
    row = benchmark_summary(runs).first()
    assert row.output_stage_ratio_candidate_vs_baseline == 0.25
    assert row.output_stage_reduction_fraction == 0.75
    assert row.output_stage_speedup_factor_baseline_vs_candidate == 4.0
    assert (row.passed, row.route, row.justification) == (True, "speedup", None)
    medians = {r.writer: r for r in benchmarks.median_metrics(benchmarks.run_metrics(runs)).collect()}
    assert medians["primary"].output_stage_seconds == 3.0 and medians["legacy"].manifest_build_seconds == 0.2
    named = spark.createDataFrame([run_rows("new", 1.0, 1.0), run_rows("old", 9.0, 9.0), run_rows("third", 1.0, 0.0)], schema)
    row = benchmark_summary(named, candidate="new", baseline="old").first()
    assert (row.output_stage_speedup_factor_baseline_vs_candidate, row.passed, row.route) == (9.0, True, "speedup")
    slow = spark.createDataFrame([run_rows("primary", 9.0, 2.0), run_rows("legacy", 8.0, 2.0)], schema)
    assert benchmark_summary(slow, justification="x").first().route == "failed"


@pytest.mark.parametrize("speedup, reduction, why, want", [
    (3.1, 0.4, None, (True, "speedup")), (2.2, 0.62, None, (False, "failed")), (2.2, 0.62, "  ", (False, "failed")),
    (2.2, 0.62, "documented", (True, "reduction_with_justification")), (1.2, 0.16, "documented", (False, "failed")),
    (None, None, "x", (False, "failed")),
])
def test_guardrail(spark, speedup, reduction, why, want):
    names = "output_stage_speedup_factor_baseline_vs_candidate double, output_stage_reduction_fraction double"
    df = spark.createDataFrame([(speedup, reduction)], names)
    row = benchmarks.guardrail(df, F.lit(why).cast("string")).first()
    assert (row.passed, row.route) == want
    assert row.justification == (why if why and why.strip() else None)


def test_zero_baseline(spark):
    ratio, reduction, speedup = benchmarks.ratios(F.lit(1.0), F.lit(0.0))
    assert tuple(spark.range(1).select(ratio, reduction, speedup).first()) == (None, None, 0.0)


def test_a_stored_snapshot_is_not_shuffled_again(spark):
    import uuid

    name = f"snapshot_{uuid.uuid4().hex}"
    old = [(f"w{k % 30}", f"p{k}", str(k)) for k in range(400)]
    new = [(w, p, h if k % 5 else "new") for k, (w, p, h) in enumerate(old) if k % 7] + [("w1", "more", "x"), (None, "p", "x")]
    frame = lambda rows: spark.createDataFrame(rows, "workbook string, part string, sha256 string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = diff.store_snapshot(frame(old), name, buckets=16)
        got = diff.part_changes(stored, frame(new))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("FileScan") < plan.index("Exchange") and "Bucketed: true" in plan
        key = lambda r: tuple(map(str, r))
        assert sorted(got.collect(), key=key) == sorted(diff.part_changes(frame(old), frame(new)).collect(), key=key)
        listing = spark.createDataFrame([(f"f{k}", k % 9, k) for k in range(50)], "path string, modified int, length int")
        files = diff.store_snapshot(listing, name + "_files", ["path"], 16)
        after = listing.withColumn("modified", F.col("modified") + F.col("length") % 2)
        fresh = diff.new_evidence(files, after, F.lit(3))
        # the other side's shuffle alone: distinct paths are counted where they are
        assert fresh._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert {r.path for r in fresh.collect()} == {f"f{k}" for k in range(50) if k % 2 and k % 9 + 1 >= 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_files")


def test_a_hot_link_is_many_tasks_work(spark):
    from tagloom.operators import grid

    results = spark.createDataFrame([("w", r, "hot" if r % 3 else None, f"c{r}") for r in range(5, 65)] + [("v", 5, "x", "c")], "workbook string, row_num int, link string, category string")
    cards = spark.createDataFrame(
        [("w", "hot", s, f"S{s}", 5, c) for s in range(40) for c in range(3, 60, 6)] + [("v", "x", 0, "S0", 5, 3), ("w", None, 1, "S1", 5, 3)],
        "workbook string, link string, sheet_idx int, sheet_name string, row_num int, col_num int",
    )
    pairs = grid._card_updates(results, cards)
    plain = results.join(cards.withColumnRenamed("row_num", "at"), ["workbook", "link"])
    assert pairs.count() == plain.count() == 40 * 400 + 1
    assert {(r.workbook, r.sheet_name, r.col_num, r.value) for r in pairs.collect()} == {(r.workbook, r.sheet_name, r.col_num, r.category) for r in plain.collect()}
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        sizes = grid._card_updates(results, cards).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 16_000 / 4
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_writable_surface_takes_overlaps_out_of_bounds(spark):
    primary = spark.createDataFrame(
        [("w", "S", "A1:C5"), ("w", "S", "B3:D9"), ("w", "S", "B3:D9"), ("w", "S", "C2:C2"), ("w", "S", "A8:A9"), ("w", "S", "Z9:Z1"),
         ("w", "T", "A1:B2"), (None, None, "A1:A2"), (None, None, "A2:A3")],
        "workbook string, sheet_name string, cell_range string",
    )
    cards = spark.createDataFrame(
        [("w", "S", 5, 3), ("w", "S", 5, 3), ("w", "S", 99, 30), ("w", "S", None, 3), ("w", "S", 4, None), ("v", "S", 5, 3)],
        "workbook string, sheet_name string, row_num int, col_num int",
    )
    surface = contract.writable_surface(primary, cards)
    got = sorted(((r.workbook, r.sheet_name, r.cell_ref) for r in surface.collect()), key=str)
    of = lambda w, s, columns, rows: {(w, s, f"{c}{r}") for c in columns for r in rows}
    wanted = of("w", "S", "ABC", range(1, 6)) | of("w", "S", "BCD", range(3, 10)) | of("w", "S", "A", (8, 9)) | of("w", "T", "AB", (1, 2))
    wanted |= of(None, None, "A", (1, 2, 3)) | {("w", "S", "AD99"), ("w", "S", None), ("v", "S", "C5")}
    assert got == sorted(wanted, key=str)
    # bounds are shuffled, cells are not
    plan = surface._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [workbook#" not in plan.split("Generate explode(sequence(from_row")[0]
    assert "cell_ref" not in plan.split("Window")[-1]
