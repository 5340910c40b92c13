"""Cut a long plan at a point that must be computed once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame], DataFrame]


def local_folder(spark: SparkSession) -> None:
    """Give a local session without a checkpoint folder a temporary one; all its tasks share that machine.

    For tests, benches and queries run by hand.  A session that names
    ``spark.checkpoint.dir`` keeps it, and one on a cluster gets none.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, or that was set on its context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    Later passes read only the columns they use, the planner knows the size,
    and a lost executor repeats nothing that came before.  Whoever owns the
    folder empties it.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
