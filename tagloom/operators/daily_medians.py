"""Exact medians of runs that grow by the day, from a state that is kept for each day.

A day's runs are read once, when its state is written: the different values of
every writer and metric with their counts, cut into fences, and one small row a
fence with its lowest and highest value and its count.  Fences of all days
together say between which values the median lies; only values of fences that
may hold it are read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tagloom.operators.benchmarks import LAST_VALUES, METRICS
from tagloom.operators.lineage import cut_lineage
from tagloom.operators.skew import spread_join

Stage = Callable[[DataFrame], DataFrame]

GROUP = ["writer", "metric"]
# Fences of a group on one day, a power of two; the counts of fences are exact, so this sets the reading only.
FENCES = 64
FENCE_SHAPE = "day string, writer string, metric string, fence int, low double, high double, n long"
VALUE_SHAPE = "day string, writer string, metric string, fence int, v double, c long"


def _fenced(values: DataFrame, keys: list[str], fences: int) -> DataFrame:
    """Add ``fence``: in which of ``fences`` ranges of about equally many rows of its group a value lies."""
    bounds = values.groupBy(*keys).agg(F.percentile_approx("v", [i / fences for i in range(1, fences)], 20 * fences).alias("q"))
    placed = spread_join(values, bounds, keys, [F.col("v")]).withColumn("fence", F.lit(0))
    step = fences // 2
    while step:  # binary search; the bounds are sorted
        at = F.col("fence")
        placed = placed.withColumn("fence", F.when(F.get("q", at + (step - 1)) <= F.col("v"), at + step).otherwise(at))
        step //= 2
    return placed.drop("q")


def _states(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the states that were written whole: their fences, which are written last, have ended well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(path))
    done = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/fences/_SUCCESS")
    return [f"{folder}/{n}" for n in names if system.exists(done(n))]


def _kept(spark: SparkSession, folder: str, part: str, shape: str) -> DataFrame:
    paths = [f"{state}/{part}" for state in _states(spark, folder)]
    return spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)


def kept_days(spark: SparkSession, folder: str) -> DataFrame:
    """``day`` of every day that has a state."""
    return _kept(spark, folder, "fences", FENCE_SHAPE).select("day").distinct()


def add_days(runs: DataFrame, folder: str, metrics: tuple[str, ...] = METRICS, fences: int = FENCES) -> None:
    """Keep the state of those days of ``runs`` (columns ``day``, ``writer`` and the metrics) that have none yet.

    Give whole days: a day that has a state is taken as known and its rows are
    left out, so a job may be repeated.  The known days, a row each, are named
    in the filter, so a table partitioned by day is not even opened there.  A
    job that is lost before its fences are written leaves nothing that counts.
    Rows without a day or a writer, and metrics that are null or not a number,
    are left out.  Let one job add at a time.
    """
    known = sorted(r.day for r in kept_days(runs.sparkSession, folder).toLocalIterator())
    runs = runs.where(~F.col("day").cast("string").isin(known)) if known else runs
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])
    fresh = runs.select(F.col("day").cast("string").alias("day"), "writer", F.inline(pairs)).dropna()
    counts = cut_lineage(fresh.groupBy("day", *GROUP, "v").agg(F.count("*").alias("c")))
    state = f"{folder}/{uuid.uuid4().hex}"
    placed = _fenced(counts, ["day", *GROUP], fences).select("day", *GROUP, "fence", "v", "c")
    placed.sortWithinPartitions(*GROUP, "v").write.parquet(f"{state}/values")
    written = runs.sparkSession.read.schema(VALUE_SHAPE).parquet(f"{state}/values")
    if not written.isEmpty():
        bounds = written.groupBy("day", *GROUP, "fence").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("c").alias("n"))
        bounds.coalesce(1).write.parquet(f"{state}/fences")


def _reach(fences: DataFrame) -> DataFrame:
    """Per group: its ``n``, and values ``lo`` and ``hi`` between which the middle ranks lie for certain.

    The middle value is at least a fence's low end if fences that begin below
    it hold too few values, and at most a fence's high end if fences that end
    there or before hold enough.
    """
    size = fences.groupBy(*GROUP).agg(F.sum("n").alias("size"))
    half = lambda x: F.call_function("div", x, F.lit(2))
    so_far = W.partitionBy(*GROUP).orderBy("end")
    starts = fences.groupBy(*GROUP, F.col("low").alias("end")).agg(F.sum("n").alias("own")).withColumn("before", F.sum("own").over(so_far) - F.col("own"))
    ends = fences.groupBy(*GROUP, F.col("high").alias("end")).agg(F.sum("n").alias("own")).withColumn("upto", F.sum("own").over(so_far))
    lo = starts.join(size, GROUP).where(F.col("before") < half(F.col("size") + 1)).groupBy(*GROUP).agg(F.max("end").alias("lo"))
    hi = ends.join(size, GROUP).where(F.col("upto") >= half(F.col("size")) + 1).groupBy(*GROUP).agg(F.min("end").alias("hi"))
    return size.join(lo, GROUP).join(hi, GROUP)


def _middle(values: DataFrame, asked: DataFrame, last_values: int, stage: Stage) -> DataFrame:
    """``(writer, metric, median)`` from counted values, of which ``below`` smaller ones are left out."""
    half = lambda x: F.call_function("div", x, F.lit(2))
    lower, upper = half(F.col("size") + 1), half(F.col("size")) + 1
    while (values.groupBy(*GROUP).agg(F.count("*").alias("d")).agg(F.max("d")).first()[0] or 0) > last_values:
        placed = stage(_fenced(values, GROUP, 4 * FENCES))
        counts = placed.groupBy(*GROUP, "fence").agg(F.sum("c").alias("own"))
        upto = F.sum("own").over(W.partitionBy(*GROUP).orderBy("fence"))
        ranks = counts.join(asked, GROUP).withColumn("upto", F.col("below") + upto).withColumn("before", F.col("upto") - F.col("own"))
        held = stage(ranks.where((F.col("upto") >= lower) & (F.col("before") < upper)).select(*GROUP, "fence", "size", "before"))
        asked = held.groupBy(*GROUP).agg(F.first("size").alias("size"), F.min("before").alias("below"))
        values = stage(spread_join(placed, held.select(*GROUP, "fence"), [*GROUP, "fence"], [F.col("v")]).drop("fence"))
    ranked = values.join(asked, GROUP).withColumn("upto", F.col("below") + F.sum("c").over(W.partitionBy(*GROUP).orderBy("v")))
    at = lambda rank: F.max(F.when((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("c")), F.col("v")))
    return ranked.groupBy(*GROUP).agg(((at(lower) + at(upper)) / 2).alias("median"))


def open_fences(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The fences whose values may be middle ones, and per group its ``size`` and the number ``below`` them."""
    fences = _kept(spark, folder, "fences", FENCE_SHAPE)
    reach = cut_lineage(_reach(fences))
    placed = fences.join(reach, GROUP)
    under = F.col("high") < F.col("lo")
    below = placed.groupBy(*GROUP).agg(F.first("size").alias("size"), F.sum(F.when(under, F.col("n")).otherwise(0)).alias("below"))
    return placed.where(~under & (F.col("low") <= F.col("hi"))).select("day", *GROUP, "fence"), below


def medians(spark: SparkSession, folder: str, metrics: tuple[str, ...] = METRICS, last_values: int = LAST_VALUES) -> DataFrame:
    """Exact median of every metric over all kept days, one row per writer, as ``benchmarks.median_metrics`` gives it.

    A task ranks the fences of one group, ``FENCES`` a day, and at last no more
    than ``last_values`` different values of one.
    """
    held, below = open_fences(spark, folder)
    values = _kept(spark, folder, "values", VALUE_SHAPE)
    keys = ["day", *GROUP, "fence"]
    inside = spread_join(values, held, keys, [F.col("v")]).groupBy(*GROUP, "v").agg(F.sum("c").alias("c"))
    found = _middle(cut_lineage(inside), cut_lineage(below), last_values, cut_lineage)
    shown: list[Column] = [F.max(F.when(F.col("metric") == m, F.col("median"))).alias(m) for m in metrics]
    return found.groupBy("writer").agg(*shown)
