"""Output names and table sinks.  A source is never overwritten."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.bind import let
from tagloom.functions.text import strip

# --- fixed values -------------------------------------------------------------
MAIN_KIND = "main"
QA_FOLDER = "qa"


def is_safe_segment(segment: Column) -> Column:
    """Whether a name is one path segment: not blank, not a dot name, no separator."""
    return let(
        strip(segment),
        lambda s: F.coalesce((s != "") & ~s.isin(".", "..") & ~s.rlike(r"[/\\]"), F.lit(False)),
    )


def _checked(valid: Column, path: Column, strict: bool, what: str) -> Column:
    otherwise = (
        F.raise_error(F.lit(f"{what} must be a single safe path segment")) if strict else F.lit(None)
    )
    return F.when(valid, path).otherwise(otherwise.cast("string"))


def dated_output(
    folder: Column, name: Column, day: Column, kind: Column | None = None, strict: bool = False
) -> Column:
    """``folder/yymmdd_kind_name``; an unsafe kind gives NULL, or fails the job when strict."""
    kind = F.lit(MAIN_KIND) if kind is None else kind
    stamped = F.concat_ws("_", F.date_format(day, "yyMMdd"), strip(kind), name)
    return _checked(is_safe_segment(kind), F.concat_ws("/", folder, stamped), strict, "artifact_kind")


def qa_output(folder: Column, name: Column, artifact: Column, strict: bool = False) -> Column:
    """``folder/qa/artifact/name``; an unsafe artifact gives NULL, or fails the job when strict."""
    path = F.concat_ws("/", folder, F.lit(QA_FOLDER), strip(artifact), name)
    return _checked(is_safe_segment(artifact), path, strict, "artifact_name")


def write_table(
    df: DataFrame, path: str, file_format: str = "parquet", partition_by: tuple[str, ...] = ()
) -> None:
    """Write a result table, refusing to replace one.

    Partition only by columns of few values: a folder per workbook would mean
    millions of small files.
    """
    df.write.mode("errorifexists").partitionBy(*partition_by).format(file_format).save(path)


# --- publishing: staged tables, and a manifest that names each workbook's version -----------------

MANIFEST_SHAPE = "workbook string, table_name string, version string, n_rows long, digest long"


def _manifest_names(spark: SparkSession, folder: str) -> list[str]:
    """Committed manifests, oldest first; their number is the number of publications."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(n for s in system.listStatus(path) if not (n := s.getPath().getName()).startswith(("_", ".")))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest committed manifest: ``(workbook, table_name, version, n_rows, digest)``, empty before the first."""
    names = _manifest_names(spark, folder)
    if not names:
        return spark.createDataFrame([], MANIFEST_SHAPE)
    return spark.read.schema(MANIFEST_SHAPE).parquet(f"{folder}/manifests/{names[-1]}")


def _commit(spark: SparkSession, staged: str, final: str) -> None:
    """Make a staged manifest visible in one step; fails if another run has committed that number."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    source, target = paths(staged), paths(final)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) or not system.rename(source, target):
        raise RuntimeError(f"another run has committed {final}")


def publish(tables: dict[str, DataFrame], folder: str) -> str:
    """Replace the rows of the workbooks in ``tables`` (each with a column ``workbook``), all at once.

    Tables are first written to a folder of their own version.  A manifest
    then lists, for each workbook and table, the version that holds it, its
    number of rows and a digest; workbooks that the run does not touch keep
    their entries.  Renaming the manifest is the only step that readers see:
    a run that is lost before leaves the old tables, and may be repeated.  A
    workbook that a run touches has its entries replaced for all tables.
    """
    spark = next(iter(tables.values())).sparkSession
    names = _manifest_names(spark, folder)
    version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex}"
    fresh = None
    for name, table in tables.items():
        path = f"{folder}/versions/{version}/{name}"
        write_table(table, path)
        stored = spark.read.parquet(path)
        digest = F.sum(F.xxhash64(*sorted(stored.columns)).bitwiseAND(F.lit((1 << 32) - 1))).alias("digest")
        rows = stored.groupBy("workbook").agg(F.count("*").alias("n_rows"), digest).select(
            "workbook", F.lit(name).alias("table_name"), F.lit(version).alias("version"), "n_rows", "digest"
        )
        fresh = rows if fresh is None else fresh.union(rows)
    kept = manifest(spark, folder).join(fresh.select("workbook").distinct(), "workbook", "left_anti")
    staged = f"{folder}/versions/{version}/_manifest"
    fresh.union(kept.select(*fresh.columns)).write.parquet(staged)
    spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests").getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
    )
    _commit(spark, staged, f"{folder}/manifests/{len(names):010d}")
    return version


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The current rows of one table, each workbook's from the version that the manifest names.

    Versions without a workbook that is current are not read.
    """
    current = manifest(spark, folder).where(F.col("table_name") == name).select("workbook", "version")
    versions = sorted(r.version for r in current.select("version").distinct().toLocalIterator())
    if not versions:
        raise ValueError(f"nothing is published of {name}")
    found = None
    for version in versions:
        own = current.where(F.col("version") == version).select("workbook")
        rows = spark.read.parquet(f"{folder}/versions/{version}/{name}").join(own, "workbook", "left_semi")
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def damaged_entries(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Manifest entries whose stored rows differ in number or digest: ``(workbook, table_name, version)``."""
    current = manifest(spark, folder).where(F.col("table_name") == name)
    rows = published(spark, folder, name)
    digest = F.sum(F.xxhash64(*sorted(rows.columns)).bitwiseAND(F.lit((1 << 32) - 1))).alias("now_digest")
    now = rows.groupBy("workbook").agg(F.count("*").alias("now_rows"), digest)
    both = current.join(now, "workbook", "left")
    same = F.col("n_rows").eqNullSafe(F.col("now_rows")) & F.col("digest").eqNullSafe(F.col("now_digest"))
    return both.where(~same).select("workbook", "table_name", "version")
