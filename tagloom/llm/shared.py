"""Tables, shared folder, staged results and connected components for the operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tagloom-"), "tagloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode, where all tasks share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tagloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result as Parquet in the shared folder and read it again.

    Lost executors then never repeat what came before, and later passes read
    only the columns they need.  Whoever owns the folder empties it.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Label the nodes of ``edges(a, b)`` with the smallest node they reach: ``(node, component)``.

    Alternates large-star and small-star steps (Kiveris et al., 2014).  Each
    step is a partial aggregate and an equi-join, so nodes with very many
    links are summed before they move; the links of each round are staged, and
    so are the sums, so that adaptive execution can split a hub's join.
    Ends when a round changes nothing.
    """
    pairs = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(small, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        pairs = stage(down.union(small.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sized(df: DataFrame, most_rows: int = 2_000_000) -> DataFrame:
    """A staged table of ids, to be broadcast if it has at most ``most_rows`` rows (16 MB) and shuffled if it has more."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
