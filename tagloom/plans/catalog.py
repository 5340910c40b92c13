"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import wraps
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.functions import layout as lay
from tagloom.functions import lexicon as lx
from tagloom.functions import model_io, refs, rules, text
from tagloom.functions.bind import evaluate_once
from tagloom.functions.html import with_article_text
from tagloom.operators import benchmarks, contract, daily_medians, diff, grid, layout, tiers
from tagloom.operators.lineage import cut_lineage, local_folder, shared_folder
from tagloom.plans import jobs
from tagloom.plans.views import view
from tagloom.plans.xml_parts import damaged_parts, package_parts
from tagloom.sources import charset, files, outputs, packages, xml_tree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BOOK_ROW = ("workbook", "row_num")


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        local_folder(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def joined(values: Column) -> Column:
    """An array as one string, for results that only hold plain values."""
    return F.array_join(values, ",")


# --- inputs shared by several queries ---------------------------------------------


def _cells(spark, sf):
    """The whole grid, staged for queries that read it several times."""
    return cut_lineage(view(spark, sf, "cells"))


def _targets(spark, sf):
    return grid.target_rows(view(spark, sf, "cells"))


def _results(spark, sf, cells=None):
    return jobs.rule_results(_targets(spark, sf) if cells is None else grid.target_rows(cells))


def _cards(spark, sf):
    return grid.card_cells(view(spark, sf, "cells"))


def _fan_out(spark, sf):
    cells = _cells(spark, sf)
    return grid.fan_out(_results(spark, sf, cells), grid.card_cells(cells))


def _winners(spark, sf, cells):
    return grid.winning_updates(_results(spark, sf, cells), grid.card_cells(cells))


def _texts(spark, sf):
    """Every document's whole text behind a Korean phrase: ``(doc_id, text)``."""
    docs = view(spark, sf, "documents").select("doc_id", "text", (F.col("doc_id") % 30).alias("i"))
    joined_text = F.concat_ws(" ", "phrase", "text").alias("text")
    return docs.join(view(spark, sf, "phrases"), "i").select("doc_id", joined_text)


def _scorer(spark, sf, model: str, shift: int) -> tiers.Scorer:
    """Recorded calls as a model: each text is sent to one of them, by its length."""
    attempts = view(spark, sf, "attempts").filter(F.col("model") == model).drop("model")
    calls = attempts.select((F.max("item") + 1).alias("n"))

    def score(requests: DataFrame) -> DataFrame:
        body = F.col("text")
        letters = F.length(F.replace(body, F.lit(" "), F.lit("")))
        call = (F.length(body) * 7 + letters * 13 + shift) % calls.scalar()
        numbered = requests.select(F.col("item").alias("request"), call.alias("item"))
        return numbered.join(attempts, "item").select(
            F.col("request").alias("item"), "attempt", "status", "response"
        )

    return score


def _scorers(spark, sf):
    return tiers.Scorers(
        _scorer(spark, sf, "A", 0), _scorer(spark, sf, "B", 0),
        _scorer(spark, sf, "A", 1), _scorer(spark, sf, "B", 1),
    )


def _page_table(spark, sf):
    return view(spark, sf, "article_pages").select("url", "html")


# --- scans ---------------------------------------------------------------------------


@query
def s1_unreadable_parts(spark, sf):
    return packages.unreadable_parts(cut_lineage(damaged_parts(spark, sf)))


@query
def s2_sheet_catalogue(spark, sf):
    return packages.sheet_catalogue(package_parts(spark, sf))


@query
def s3_shared_strings(spark, sf):
    return packages.shared_strings(package_parts(spark, sf))


@query
def s4_cell_scan(spark, sf):
    parts = package_parts(spark, sf)
    return packages.cells(parts, packages.sheet_catalogue(parts)).drop("sheet_idx", "hyperlink", "formula", "style")


@query
def s5_hyperlinks(spark, sf):
    parts = package_parts(spark, sf)
    return packages.hyperlinks(parts, packages.sheet_catalogue(parts))


@query
def s6_defined_names(spark, sf):
    return packages.defined_names(package_parts(spark, sf))


@query
def s7_merge_ranges(spark, sf):
    parts = package_parts(spark, sf)
    return packages.merges(parts, packages.sheet_catalogue(parts)).withColumn("merges", joined(F.col("merges")))


@query
def s8_link_text(spark, sf):
    cells = view(spark, sf, "cells").filter("(sheet_idx = 0 AND col_num = 11) OR (sheet_idx > 0 AND row_num = 4)")
    return cells.select(*grid.CELL_KEY, text.link_text(F.col("hyperlink"), F.col("value")).alias("link"))


@query
def s9_single_input(spark, sf):
    return files.single_inputs(view(spark, sf, "input_listing"))


@query
def s10_newest_artifact(spark, sf):
    return files.newest(view(spark, sf, "listing_before"))


@query
def s12_article_source(spark, sf):
    pages = view(spark, sf, "article_pages").select("page_id", "url", F.sha2("html", 256).alias("html_sha256"))
    return tiers.article_sources(_targets(spark, sf), pages).select(*BOOK_ROW, "link", "page_id", "html_sha256")


@query
def s13_charset_cascade(spark, sf):
    docs = view(spark, sf, "documents").withColumn("i", F.col("doc_id") % 30).join(view(spark, sf, "phrase_bytes"), "i")
    every = docs.select("doc_id", "text", "cp949", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("way"))
    way = F.col("way")
    # what the Korean code page has besides the phrase is ASCII; other characters are put as question marks
    mapped = F.encode(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\\x00-\\x7F]", "?"), "UTF-8")
    korean = F.concat(F.unhex("cp949"), F.encode(F.lit(" "), "UTF-8"), mapped)
    pages = every.select(
        "doc_id", "way",
        F.when(way == 1, F.encode("text", "UTF-16")).when(way >= 3, korean).otherwise(F.encode("text", "UTF-8")).alias("content"),
        F.when(way == 1, "utf-16").when(way == 2, "no-such-charset").when(way == 4, "ms949").when(way == 5, "euc-kr").alias("declared"),
    )
    return pages.select("doc_id", "way", charset.decode_page(F.col("content"), F.col("declared")).alias("text"))


@query
def s14_dated_output(spark, sf):
    names = view(spark, sf, "output_names")
    path = outputs.dated_output(F.lit("output"), F.col("name"), F.col("o_orderdate"), F.col("kind"))
    return names.select("o_orderkey", path.alias("path"))


@query
def s15_qa_output(spark, sf):
    names = view(spark, sf, "output_names")
    return names.select("o_orderkey", outputs.qa_output(F.lit("output"), F.col("name"), F.col("kind")).alias("path"))


# --- projections and filters -------------------------------------------------------------


@query
def p1_target_rows(spark, sf):
    return _targets(spark, sf)


@query
def p1_target_rows_wide(spark, sf):
    return grid.targets_of_list(view(spark, sf, "post_list"))


@query
def p2_target_count(spark, sf):
    return grid.target_counts(_targets(spark, sf))


@query
def p3_clean_title(spark, sf):
    return _texts(spark, sf).select("doc_id", text.clean_title(F.col("text")).alias("title"))


@query
def p4_skip_final(spark, sf):
    cells = view(spark, sf, "cells")
    return cells.filter(~text.final_label(F.col("value"))).select(*grid.CELL_KEY, "value")


@query
def p5_label_membership(spark, sf):
    return view(spark, sf, "model_answers").select("doc_id", rules.is_label(F.col("answer")).alias("is_label"))


@query
def p6_ref_encode(spark, sf):
    items = view(spark, sf, "lineitem")
    ref = refs.cell_ref(F.col("l_linenumber"), F.col("l_partkey"))
    return items.select("l_orderkey", "l_linenumber", "l_partkey", ref.alias("cell_ref"))


@query
def p6_ref_decode(spark, sf):
    grid_cells = view(spark, sf, "grid_before")
    ref = F.col("cell_ref")
    return grid_cells.select(
        "workbook", "sheet_name", "cell_ref", refs.ref_row(ref).alias("row_num"), refs.ref_column(ref).alias("col_num")
    )


@query
def p7_weak_labels(spark, sf):
    labelled = k4_normalise_label(spark, sf)
    return labelled.filter(rules.is_weak(F.col("label")))


# --- classification -------------------------------------------------------------------------


@query
def k1_rule_cascade_strict(spark, sf):
    return evaluate_once(_texts(spark, sf), "label", rules.classify_strict(F.col("text"))).select("doc_id", "label")


@query
def k1_rules_on_documents(spark, sf):
    docs = view(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", rules.classify_strict(F.col("text")).alias("label"))


@query
def k2_rule_cascade_general(spark, sf):
    return _texts(spark, sf).select("doc_id", rules.classify_general(F.col("text")).alias("label"))


@query
def k3_title_rules(spark, sf):
    posts = view(spark, sf, "post_list")
    return posts.select(*BOOK_ROW, rules.classify_title(F.col("title")).alias("label"))


@query
def k4_normalise_label(spark, sf):
    return view(spark, sf, "model_answers").select("doc_id", rules.normalise_label(F.col("answer")).alias("label"))


@query
def k5_title_prompt(spark, sf):
    targets = _targets(spark, sf)
    return targets.select(*BOOK_ROW, F.sha2(model_io.title_prompt(F.col("title")), 256).alias("prompt_sha256"))


@query
def k6_body_prompt(spark, sf):
    docs = view(spark, sf, "documents")
    return docs.select("doc_id", F.sha2(model_io.body_prompt(F.col("text")), 256).alias("prompt_sha256"))


@query
def k7_request_body(spark, sf):
    body = model_io.request_body(F.col("text"), model_io.SECOND_MODEL, model_io.body_prompt)
    requests = evaluate_once(view(spark, sf, "documents"), "body", body)
    at = lambda path: F.get_json_object("body", path)
    return requests.select(
        "doc_id", at("$.model").alias("model"), at("$.messages[0].role").alias("first_role"),
        F.sha2(at("$.messages[0].content"), 256).alias("prompt_sha256"),
        at("$.messages[1].role").alias("second_role"), at("$.messages[1].content").alias("user_text"),
    )


@query
def k8_response_label(spark, sf):
    attempts = view(spark, sf, "attempts")
    return attempts.select("item", "model", "attempt", model_io.response_label(F.col("response")).alias("label"))


@query
def k9_first_success(spark, sf):
    return tiers.first_success(view(spark, sf, "attempts"), ["item", "model"])


@query
def k10_article_text(spark, sf):
    return with_article_text(view(spark, sf, "article_pages").select("page_id", "html"))


@query
def k11_body_tier(spark, sf):
    pages = view(spark, sf, "article_pages").select("page_id", "html")
    articles = with_article_text(pages).filter("article_text IS NOT NULL")
    return tiers.body_labels(articles, _scorers(spark, sf), key="page_id")


@query
def k12_article_tier(spark, sf):
    return tiers.article_categories(_targets(spark, sf), _page_table(spark, sf), _scorers(spark, sf))


@query
def k13_tier_resolver(spark, sf):
    posts = view(spark, sf, "post_list").select(*BOOK_ROW, "title", "link")
    resolved = tiers.resolve_categories(posts, _page_table(spark, sf), _scorers(spark, sf))
    return resolved.select(*BOOK_ROW, "category", "method")


@query
def k14_title_only(spark, sf):
    posts = view(spark, sf, "post_list").select(*BOOK_ROW, "title")
    return tiers.title_categories(posts, _page_table(spark, sf), _scorers(spark, sf))


@query
def k15_batch_summary(spark, sf):
    batch = jobs.classify_grids(view(spark, sf, "cells"), _page_table(spark, sf), _scorers(spark, sf))
    return batch.summary


@query
def k15_batch_grid(spark, sf):
    batch = jobs.classify_grids(view(spark, sf, "cells"), _page_table(spark, sf), _scorers(spark, sf))
    return batch.cells.select(*grid.CELL_KEY, "value", "has_formula")


# --- joins ---------------------------------------------------------------------------------------


@query
def j1_card_index(spark, sf):
    return _cards(spark, sf).select("workbook", "link", "sheet_name", "row_num", "col_num")


@query
def j2_card_targets(spark, sf):
    rules = contract.contract_card_rules(view(spark, sf, "workbooks"), _contracts(spark, sf, {"f1": 2}))
    cards = grid.card_cells(view(spark, sf, "cells"), rules, skip_final=False)
    targets = contract.card_targets(cards, view(spark, sf, "sheets"))
    entry = F.explode("card_targets").alias("e")
    return targets.select("workbook", entry).select("workbook", F.col("e.key").alias("sheet_name"), joined(F.col("e.value")).alias("refs"))


@query
def j3_fan_out(spark, sf):
    return _fan_out(spark, sf).select(*grid.CELL_KEY, "value", F.col("seq.target_row").alias("target_row"))


@query
def j4_upsert(spark, sf):
    cells = _cells(spark, sf)
    written = grid.upsert(cells, _winners(spark, sf, cells), grid.writable_places())
    return written.select("sheet_idx", *grid.CELL_KEY, "value", "has_formula")


@query
def j5_surface_violations(spark, sf):
    found = _violations(spark, sf)
    return found.select("workbook", "sheet_name", "cell_ref", "code", "detail")


@query
def j6_part_changes(spark, sf):
    return diff.part_changes(view(spark, sf, "parts_left"), view(spark, sf, "parts_right"))


@query
def j7_untouched_cells(spark, sf):
    cells = _cells(spark, sf)
    return cells.join(_winners(spark, sf, cells), grid.CELL_KEY, "left_anti").select(*grid.CELL_KEY, "value")


@query
def j8_sheet_parts(spark, sf):
    sheets = view(spark, sf, "sheets")
    named = sheets.filter("state = 'hidden'").select("workbook", "sheet_name")
    return diff.sheet_parts(named, sheets)


# --- aggregates -------------------------------------------------------------------------------------


@query
def a1_category_summary(spark, sf):
    return grid.category_summary(_results(spark, sf))


@query
def a2_method_counts(spark, sf):
    resolved = tiers.resolve_categories(_targets(spark, sf), _page_table(spark, sf), _scorers(spark, sf))
    return grid.method_counts(resolved)


@query
def a3_card_positions(spark, sf):
    nested = grid.card_positions(_cards(spark, sf))
    place = lambda p: F.format_string("%s!%s", p["sheet_name"], refs.cell_ref(p["row_num"], p["col_num"]))
    return nested.select("workbook", "link", joined(F.transform("positions", place)).alias("positions"))


@query
def a4_updates_by_sheet(spark, sf):
    nested = grid.updates_by_sheet(_winners(spark, sf, _cells(spark, sf)))
    entry = lambda e: F.concat_ws("=", e["key"], e["value"])
    pairs = F.array_sort(F.transform(F.map_entries("cells"), entry))
    return nested.select("workbook", "sheet_name", joined(pairs).alias("cells"))


@query
def a5_object_counts(spark, sf):
    return diff.object_counts(view(spark, sf, "parts_left"))


@query
def a6_max_column(spark, sf):
    declared = view(spark, sf, "sheets").filter("sheet_idx % 4 = 1").select(
        "workbook", "sheet_name", F.lit("A1:AZ40").alias("ref")
    )
    return layout.sheet_max_columns(view(spark, sf, "cells"), declared)


@query
def a7_fingerprint(spark, sf):
    prints = _prints(spark, sf)
    states = F.transform("sheet_states", lambda s: F.concat_ws("=", s["key"], s["value"]))
    return prints.select(
        "workbook", "file_sha256", "workbook_xml_sha256",
        joined(F.col("sheet_order")).alias("sheet_order"), joined(states).alias("sheet_states"),
    )


@query
def a8_median_metrics(spark, sf):
    return benchmarks.median_metrics(benchmarks.run_metrics(view(spark, sf, "bench_runs")))


@query
def a8_daily_medians(spark, sf):
    """The same from states kept by day; a second job adds the days that a first one did not know."""
    folder = f"{shared_folder(spark)}/run-days-{uuid.uuid4().hex}"
    runs = benchmarks.run_metrics(view(spark, sf, "bench_runs"))
    for grown in (runs.where(F.dayofmonth("day") <= 15), runs):
        daily_medians.add_days(grown, folder)
    return daily_medians.medians(spark, folder)


@query
def a9_writer_comparison(spark, sf):
    return benchmarks.compare_writers(a8_median_metrics(spark, sf))


@query
def a10_guardrail(spark, sf):
    return jobs.benchmark_summary(view(spark, sf, "bench_runs"), justification="layout parity work").select(
        "passed", "route", "justification"
    )


@query
def a11_run_counts(spark, sf):
    return benchmarks.run_counts(_fan_out(spark, sf), _targets(spark, sf))


# --- windows ------------------------------------------------------------------------------------------


@query
def w1_last_write(spark, sf):
    return grid.last_writes(_fan_out(spark, sf)).select(*grid.CELL_KEY, "value")


@query
def w2_progress(spark, sf):
    return grid.progress(_results(spark, sf))


@query
def w3_coalesce_ranges(spark, sf):
    ranges = view(spark, sf, "column_ranges")
    columns = ranges.select(
        "workbook", "sheet_name", F.explode(F.sequence("start_col", "end_col")).alias("col_num"), "attrs"
    ).groupBy("workbook", "sheet_name", "col_num").agg(F.max("attrs").alias("attrs"))
    return layout.coalesce_ranges(columns)


@query
def w4_first_violation(spark, sf):
    return contract.first_violation(_violations(spark, sf))


@query
def w5_reindexed_sheets(spark, sf):
    return layout.without_sheet(view(spark, sf, "sheets"), "S2").select("workbook", "sheet_name", "old_idx", "sheet_idx")


# --- sorts ----------------------------------------------------------------------------------------------


@query
def o1_summary_sorted(spark, sf):
    return grid.category_summary(_results(spark, sf)).orderBy("workbook", "category")


@query
def o2_targets_sorted(spark, sf):
    return _targets(spark, sf).orderBy("workbook", "row_num")


@query
def o3_newest_per_user(spark, sf):
    events = view(spark, sf, "events").select(
        "user_id", F.col("ts").alias("modified"), F.col("event_id").cast("string").alias("path")
    )
    return files.newest(events, "user_id")


@query
def o4_sorted_changes(spark, sf):
    changes = diff.part_changes(view(spark, sf, "parts_left"), view(spark, sf, "parts_right"))
    changed = changes.filter("status = 'changed'").select("workbook", F.inline(F.array(diff.error("changed", F.col("part")))))
    report = diff.error_report(changed)
    return report.select("workbook", joined(F.col("items")).alias("parts"))


# --- sets -----------------------------------------------------------------------------------------------


@query
def e1_part_difference(spark, sf):
    left, right = view(spark, sf, "parts_left"), view(spark, sf, "parts_right")
    side = lambda a, b, name: diff.only_in(a, b).withColumn("side", F.lit(name))
    return side(right, left, "added").unionByName(side(left, right, "removed"))


@query
def e2_changed_in_both(spark, sf):
    return diff.in_both_but_changed(view(spark, sf, "parts_left"), view(spark, sf, "parts_right"))


@query
def e3_expand_ranges(spark, sf):
    cells = contract.expand_ranges(view(spark, sf, "ranges"))
    return cells.select("workbook", "sheet_name", "cell_range", "cell_ref")


@query
def e4_writable_surface(spark, sf):
    return contract.writable_surface(view(spark, sf, "ranges"), grid.card_cells(view(spark, sf, "cells"), skip_final=False))


@query
def e5_allowed_hashes(spark, sf):
    books = view(spark, sf, "workbooks")
    single = F.when(F.col("family") == "f0", F.col("workbook_xml_sha256")).otherwise("")
    several = F.array("file_sha256", "workbook_xml_sha256")
    hashes = F.array_sort(contract.allowed_hashes(single, several))
    return books.select("workbook", joined(hashes).alias("hashes"))


@query
def e8_unexpected_changes(spark, sf):
    changes = diff.part_changes(view(spark, sf, "parts_left"), view(spark, sf, "parts_right"))
    writable = view(spark, sf, "sheets").filter("sheet_idx <= 2").select("workbook", "part")
    return diff.unexpected_changes(
        changes, writable, exact=["xl/part25.xml"], prefixes=["xl/media/"], patterns=[r"xl/part3\d\.xml", "xl/draw"]
    )


@query
def e8_compiled_allowlist(spark, sf):
    """Unexpected changes under an allowlist as it would be written to a file."""
    text = json.dumps({
        "allowed_changed_parts": ["xl/part25.xml"], "allowed_changed_part_prefixes": ["xl/drawings/"],
        "allowed_changed_part_patterns": [r"xl/part3\d\.xml"], "allowed_changed_sheet_names": ["S0"],
        "include_contract_writable_surface_sheet_xml": True,
    })
    settings = spark.createDataFrame([(text,)], "body string").select(F.from_json("body", files.ALLOWLIST_SCHEMA).alias("a")).select("a.*")
    allowlist = diff.compiled_allowlist(settings)
    changes = diff.part_changes(view(spark, sf, "parts_left"), view(spark, sf, "parts_right"))
    sheets = view(spark, sf, "sheets")
    allowed = diff.allowed_parts(allowlist, sheets, sheets.filter("sheet_idx = 4"))
    return diff.unexpected_changes(changes, allowed, allowlist.parts, allowlist.prefixes, allowlist.patterns)


@query
def e6_state_variants(spark, sf):
    """Each workbook's own states as the single map, and as a list where the family asks for one."""
    sheets = view(spark, sf, "sheets")
    books = sheets.groupBy("workbook").agg(F.map_from_entries(F.collect_list(F.struct("sheet_name", "state"))).alias("own"))
    listed = F.when(F.length("workbook") % 2 == 0, F.array("own", F.map_filter("own", lambda k, v: v == "hidden")))
    variants = contract.state_variants(listed, F.col("own"))
    shown = F.transform(variants, lambda v: joined(F.transform(v, lambda e: F.concat_ws("=", e["key"], e["value"]))))
    return books.select("workbook", F.array_join(shown, ";").alias("variants"))


@query
def e7_target_variants(spark, sf):
    """Each workbook's own card cells as JSON text, next to entries that are none."""
    cards = view(spark, sf, "cards").withColumn("ref", refs.cell_ref(F.lit(5), F.col("card_start") + 1))
    own = cards.groupBy("workbook", "sheet_name").agg(F.array_sort(F.collect_set("ref")).alias("refs"))
    books = own.groupBy("workbook").agg(F.map_from_entries(F.collect_list(F.struct("sheet_name", "refs"))).alias("own"))
    text = F.to_json("own")
    several = F.concat(F.lit('["malformed", 7, {"S0": "not a list"}, '), text, F.lit("]"))
    variants = F.array_sort(contract.target_variants(text, several))
    entry = lambda e: F.concat_ws("=", e["key"], joined(e["value"]))
    shown = F.transform(variants, lambda v: F.array_join(F.transform(v, entry), " "))
    return books.select("workbook", F.array_join(F.array_sort(shown), ";").alias("variants"))


@query
def e9_branches(spark, sf):
    return _fan_out(spark, sf).groupBy("workbook", F.col("seq.branch").alias("branch")).agg(F.count("*").alias("n"))


# --- layout ------------------------------------------------------------------------------------------------


@query
def l1_page_count(spark, sf):
    items = view(spark, sf, "lineitem")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", lay.page_count(F.col("l_partkey")).alias("pages"))


@query
def l2_shift_column(spark, sf):
    items = view(spark, sf, "lineitem")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", lay.shift_column(F.col("l_partkey")).alias("col"))


@query
def l3_print_area(spark, sf):
    return layout.print_areas(layout.sheet_max_columns(view(spark, sf, "cells")))


@query
def l4_shift_marker(spark, sf):
    items = view(spark, sf, "lineitem")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", lay.shift_marker(F.col("l_partkey")).alias("col"))


@query
def l5_shift_refs(spark, sf):
    items = view(spark, sf, "lineitem").withColumn(
        "refs",
        F.concat(
            F.char(64 + F.col("l_linenumber")), F.col("l_partkey").cast("string"), F.lit("  B2:"),
            F.char(66 + F.col("l_suppkey") % 24), F.lit("35 other\t"),
        ),
    )
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lay.shift_ref_list(F.col("refs")).alias("refs"))


@query
def l6_shift_spans(spark, sf):
    items = view(spark, sf, "lineitem")
    span = F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    return items.select("l_orderkey", "l_linenumber", "l_partkey", lay.shift_span(span).alias("span"))


@query
def l7_paged_columns(spark, sf):
    following = F.lead("start_col").over(W.partitionBy("workbook", "sheet_name").orderBy("start_col"))
    ranges = view(spark, sf, "column_ranges").groupBy("workbook", "sheet_name", "start_col").agg(
        F.max("attrs").alias("attrs"), F.max("end_col").alias("end_col")
    ).withColumn("end_col", F.least("end_col", F.coalesce(following - 1, "end_col")))
    return layout.paged_columns(ranges, layout.sheet_max_columns(view(spark, sf, "cells")))


@query
def l8_repaginate(spark, sf):
    return layout.repaginate(view(spark, sf, "cells")).select(*grid.CELL_KEY, "value")


@query
def l9_defined_names(spark, sf):
    areas = layout.print_areas(layout.sheet_max_columns(view(spark, sf, "cells")))
    return layout.defined_names_after_layout(view(spark, sf, "names"), view(spark, sf, "sheets"), areas, "S2")


@query
def l10_active_tab(spark, sf):
    return layout.active_tab_after(view(spark, sf, "tabs"), view(spark, sf, "sheets"), "S2")


@query
def l11_page_outlines(spark, sf):
    return layout.page_outlines(layout.sheet_max_columns(view(spark, sf, "cells")))


# --- validation -----------------------------------------------------------------------------------------------


def contract_json(family: str, hash_list: list[str], write_offset: int = 1) -> str:
    """A contract for the derived workbooks, as it would be written to a file."""
    order = [lx.TARGET_SHEET] + [f"S{i}" for i in range(8)]
    cards: dict[str, list[str]] = {}
    for slot in range(40):
        if slot % 11 != 3 and slot % 13 != 5 and slot % 17 != 1:
            cards.setdefault(f"S{slot % 8}", []).append(["C5", "I5", "O5", "U5", "AA5"][slot // 8])
    return json.dumps({
        "family": family,
        "supported_workbook_family": {"workbook_xml_sha256": "", "workbook_xml_sha256_allowlist": hash_list},
        "preserved_topology": {
            "sheet_count": 9, "sheet_order": order,
            "sheet_states_variants": [{name: "hidden" if name == "S7" else "visible" for name in order}],
        },
        "writable_surface": {
            "primary_target": {"sheet_name": lx.TARGET_SHEET, "allowed_ranges": ["G5:G220"]},
            "linked_card_rules": {"write_column_offset_from_anchor": write_offset},
            "linked_card_targets": cards, "linked_card_targets_variants": ["malformed", {"S0": "not a list"}],
        },
    })


def _contracts(spark, sf, write_offsets: dict[str, int] | None = None):
    offsets = write_offsets or {}
    rows = [(contract_json(f, [sha256(f.encode()).hexdigest()], offsets.get(f, 1)),) for f in ("f0", "f1")]
    raw = spark.createDataFrame(rows, "body string")
    parsed = raw.select(F.from_json("body", files.CONTRACT_SCHEMA).alias("c")).select("c.*")
    return contract.normalise_contracts(parsed)


def _prints(spark, sf):
    sheets = view(spark, sf, "sheets")
    cards = grid.card_cells(view(spark, sf, "cells"), skip_final=False)
    return contract.fingerprints(sheets, view(spark, sf, "workbooks"), contract.card_targets(cards, sheets))


def _violations(spark, sf):
    cards = grid.card_cells(view(spark, sf, "cells"), skip_final=False)
    primary = view(spark, sf, "workbooks").select(
        "workbook", F.lit(lx.TARGET_SHEET).alias("sheet_name"), F.lit("G5:G220").alias("cell_range")
    )
    return contract.surface_violations(view(spark, sf, "writes"), primary, cards)


def _decisions(spark, sf):
    return jobs.decide_writers(
        view(spark, sf, "cells"), view(spark, sf, "sheets"), view(spark, sf, "workbooks"),
        _contracts(spark, sf), view(spark, sf, "writes"),
    )


@query
def v1_contract_check(spark, sf):
    return contract.check_contracts(_prints(spark, sf), _contracts(spark, sf))


@query
def v2_runtime_contract(spark, sf):
    own = contract.runtime_contracts(_contracts(spark, sf), _prints(spark, sf))
    states = F.transform(F.col("state_variants")[0], lambda s: F.concat_ws("=", s["key"], s["value"]))
    refs_of = F.transform(F.col("card_variants")[0], lambda t: F.concat_ws("=", t["key"], joined(t["value"])))
    return own.select("workbook", "family", "target_sheet", joined(states).alias("states"), F.array_join(refs_of, ";").alias("card_refs"))


@query
def v3_writer_decision(spark, sf):
    return _decisions(spark, sf)


@query
def v4_supported_updates(spark, sf):
    return contract.supported_only(view(spark, sf, "writes"), _decisions(spark, sf))


@query
def v4_rejects(spark, sf):
    return contract.rejects(_decisions(spark, sf))


@query
def v5_package_errors(spark, sf):
    sheets, cells = cut_lineage(view(spark, sf, "sheets")), _cells(spark, sf)
    moved = sheets.withColumn("state", F.when(F.col("sheet_name") == "S5", "hidden").otherwise(F.col("state")))
    merges = lambda part: cells.groupBy("workbook", "sheet_name").agg(
        F.max("col_num").alias("m")
    ).select("workbook", "sheet_name", F.array((F.col("m") % part).cast("string")).alias("merges"))
    names = view(spark, sf, "names")
    left = jobs.Snapshot(view(spark, sf, "parts_left"), sheets, names, merges(1000), view(spark, sf, "grid_before"))
    right = jobs.Snapshot(view(spark, sf, "parts_right"), moved, names, merges(29), view(spark, sf, "grid_after"))
    surface = _surface(sheets.filter("sheet_idx IN (1, 2)"), whole=2)
    return jobs.package_errors(left, right, surface, diff.Allowlist(prefixes=("xl/media/",), include_writable=True))


WHOLE_SHEET = "A1:XFD1048576"


def _surface(sheets, whole):
    """Cell C5 of every sheet, in lower case, and the sheets of one place as a whole."""
    ranges = F.when(F.col("sheet_idx") == whole, F.array(F.lit("c5"), F.lit(WHOLE_SHEET))).otherwise(F.array(F.lit("c5")))
    return contract.writable_bounds(sheets.select("workbook", "sheet_name", F.explode(ranges).alias("cell_range")))


def _first_sheets(sheets):
    """The target range of the sheets that have a part."""
    return contract.writable_bounds(
        sheets.filter("part = 'xl/worksheets/sheet1.xml'").select("workbook", "sheet_name", F.lit("G5:G220").alias("cell_range"))
    )


@query
def v5_package_report(spark, sf):
    parts = cut_lineage(package_parts(spark, sf))
    left, right = jobs.snapshot(parts), jobs.snapshot(cut_lineage(damaged_parts(spark, sf, parts)))
    return jobs.package_errors(left, right, _first_sheets(left.sheets), diff.Allowlist(include_writable=True))


@query
def v6_cell_drift(spark, sf):
    surface = _surface(view(spark, sf, "sheets"), whole=3)
    return diff.cell_drift(view(spark, sf, "grid_before"), view(spark, sf, "grid_after"), surface)


@query
def v6_sheet_drift(spark, sf):
    parts = cut_lineage(package_parts(spark, sf))
    sheets = packages.sheet_catalogue(parts)
    nodes = lambda p: xml_tree.sheet_nodes(p, sheets)
    found = diff.tree_drift(nodes(parts), nodes(damaged_parts(spark, sf, parts)), _first_sheets(sheets))
    return found.select("workbook", "sheet_name", "path", "change")


SINCE = "2024-01-10 00:00:00"


@query
def v7_new_evidence(spark, sf):
    return diff.new_evidence(
        view(spark, sf, "listing_before"), view(spark, sf, "listing_after"), F.to_timestamp(F.lit(SINCE)), ["folder", "path"]
    )


@query
def v8_gate_verdict(spark, sf):
    found = v7_new_evidence(spark, sf).groupBy("folder").agg(F.count("*").alias("evidence"))
    after = view(spark, sf, "listing_after")
    runs = after.groupBy("folder").agg(
        (F.min("length") % 2 == 0).alias("normal_open"), (F.max("length") % 2 == 0).alias("repair_open")
    )
    both = runs.join(found, "folder", "left").withColumn("evidence", F.coalesce("evidence", F.lit(0)))
    repair, passed = diff.gate_verdict(F.col("evidence"), F.col("normal_open"), F.col("repair_open"))
    return both.select("folder", "evidence", repair.alias("repair_detected"), passed.alias("passed"))
