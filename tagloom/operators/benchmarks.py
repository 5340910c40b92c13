"""Summaries of benchmark runs: medians, comparison of two writers, guardrail."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.functions.text import strip
from tagloom.operators.lineage import cut_lineage

Stage = Callable[[DataFrame], DataFrame]

# --- fixed values: measured phases and thresholds --------------------------------
METRICS = (
    "load_seconds", "manifest_build_seconds", "classify_seconds", "write_seconds",
    "save_seconds", "output_stage_seconds", "total_seconds",
)
SPEEDUP_MIN = 3.0
REDUCTION_MIN = 0.60

# Quantile grid of one narrowing, and the sketch's rank error, which is far finer.
GRID = 500
ACCURACY = 10_000
# A group with so few distinct values left is ranked by one task.
LAST_VALUES = 20_000


def run_metrics(runs: DataFrame) -> DataFrame:
    """Add the output stage, which is writing and saving together."""
    return runs.withColumn("output_stage_seconds", F.col("write_seconds") + F.col("save_seconds"))


def run_counts(updates: DataFrame, targets: DataFrame) -> DataFrame:
    """Updates and classified rows per workbook."""
    written = updates.groupBy("workbook").agg(F.count("*").alias("update_count"))
    classified = targets.groupBy("workbook").agg(F.count("*").alias("classified_count"))
    return classified.join(written, "workbook", "left").select(
        "workbook", F.coalesce("update_count", F.lit(0)).alias("update_count"), "classified_count"
    )


def long_metrics(runs: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("seconds")) for m in metrics]
    )
    return runs.select("writer", F.inline(pairs))


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _middle_ranks(n: Column) -> tuple[Column, Column]:
    half = lambda x: F.call_function("div", x, F.lit(2))
    return half(n + 1), half(n) + 1


def _bracket(state: DataFrame, keys: list[str]) -> DataFrame:
    """Grid values around the middle ranks, one grid step wide of the sketch's error."""
    lower, upper = _middle_ranks(F.col("n"))
    low = (F.floor((lower - F.col("below")) * GRID / F.col("m")) - 1).cast("int")
    high = (F.ceil((upper - F.col("below")) * GRID / F.col("m")) + 1).cast("int")
    return state.select(
        *keys, "n", "below",
        F.when(low <= 0, F.lit(float("-inf"))).otherwise(F.get("q", low)).alias("lo"),
        F.when(high >= GRID, F.lit(float("inf"))).otherwise(F.get("q", high)).alias("hi"),
    )


def exact_median(
    values: DataFrame, keys: list[str], value: str, last_values: int = LAST_VALUES, stage: Stage = cut_lineage
) -> DataFrame:
    """Exact median per group: ``(*keys, median)``, the mean of the middle two when even.

    The built-in exact median keeps a whole group's values in one task.  Here a
    sketch of bounded size brackets the middle ranks; values outside are only
    counted.  Each narrowing leaves about one row in a hundred and is staged,
    so the next one reads little; it goes on until no group has more than
    about ``last_values`` distinct values left, which a window ranks.
    """
    rows = values.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    v = F.col("v")
    state = stage(
        rows.groupBy(*keys)
        .agg(F.count("*").alias("n"), _sketch(v).alias("q"), F.approx_count_distinct("v").alias("distinct"))
        .select("*", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("m"))
    )
    while (state.agg(F.max("distinct")).first()[0] or 0) > last_values:
        placed = rows.join(_bracket(state, keys), keys)
        inside = v.between(F.col("lo"), F.col("hi"))
        under = placed.filter(v < F.col("lo")).groupBy(*keys).agg(F.count("*").alias("under"))
        rows = stage(placed.filter(inside).select(*keys, "v"))
        state = stage(
            rows.groupBy(*keys)
            .agg(F.count("*").alias("m"), _sketch(v).alias("q"), F.approx_count_distinct("v").alias("distinct"))
            .join(state.select(*keys, "n", F.col("below").alias("before")), keys)
            .join(under, keys, "left")
            .withColumn("below", F.col("before") + F.coalesce("under", F.lit(0)))
            .drop("before", "under")
        )
    ranked = (
        rows.groupBy(*keys, "v").agg(F.count("*").alias("c"))
        .join(state.select(*keys, "n", "below"), keys)
        .withColumn("last", F.col("below") + F.sum("c").over(W.partitionBy(*keys).orderBy("v")))
    )
    at = lambda rank: F.max(
        F.when((rank <= F.col("last")) & (rank > F.col("last") - F.col("c")), v)
    )
    lower, upper = _middle_ranks(F.col("n"))
    return ranked.groupBy(*keys).agg(((at(lower) + at(upper)) / 2).alias("median"))


def median_metrics(runs: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Median of every metric, one row per writer."""
    medians = exact_median(long_metrics(runs, metrics), ["writer", "metric"], "seconds")
    return medians.groupBy("writer").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("median"))).alias(m) for m in metrics]
    )


def ratios(candidate: Column, baseline: Column) -> tuple[Column, Column, Column]:
    """(candidate / baseline, saved share of the baseline, baseline / candidate); NULL for a zero divisor."""
    return (
        F.try_divide(candidate, baseline),
        F.try_divide(baseline - candidate, baseline),
        F.try_divide(baseline, candidate),
    )


def compare_writers(
    medians: DataFrame, candidate: str = "primary", baseline: str = "legacy"
) -> DataFrame:
    """One row that compares the output stage of two writers."""
    stage = lambda writer: F.max(F.when(F.col("writer") == writer, F.col("output_stage_seconds")))
    ratio, reduction, speedup = ratios(F.col("c"), F.col("b"))
    return medians.agg(stage(candidate).alias("c"), stage(baseline).alias("b")).select(
        ratio.alias("output_stage_ratio_candidate_vs_baseline"),
        reduction.alias("output_stage_reduction_fraction"),
        speedup.alias("output_stage_speedup_factor_baseline_vs_candidate"),
    )


def guardrail(comparison: DataFrame, justification: Column | None = None) -> DataFrame:
    """Pass by speed-up, or by reduction with a written justification."""
    reason = F.lit(None).cast("string") if justification is None else justification
    reason = F.when(F.length(strip(reason)) > 0, reason)
    fast = F.coalesce(
        F.col("output_stage_speedup_factor_baseline_vs_candidate") >= SPEEDUP_MIN, F.lit(False)
    )
    lean = F.coalesce(
        (F.col("output_stage_reduction_fraction") >= REDUCTION_MIN) & reason.isNotNull(), F.lit(False)
    )
    route = (
        F.when(fast, "speedup").when(lean, "reduction_with_justification").otherwise("failed")
    )
    return comparison.select(
        "*", (fast | lean).alias("passed"), route.alias("route"), reason.alias("justification")
    )
