"""Look up one row per key from a large left side whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every key is dealt out over this many parts, so one with a third of all rows is a fiftieth of them at most.
PARTS = 16
# Rows without a key match nothing; they are dealt out over this many parts.
NULL_PARTS = 1 << 20


def spread_lookup(left: DataFrame, right: DataFrame, key: str, spread_by: list[Column], parts: int = PARTS) -> DataFrame:
    """``left`` left-joined to ``right`` (one row per key) without a hot task.

    Left rows are dealt out over ``parts`` by a hash of ``spread_by``, which
    should tell the rows of one key apart, and each right row is repeated for
    every part; rows with a NULL key are dealt out as well.  The plan is the
    same whatever the data.  Keep wide columns out of ``right``.
    """
    deal = F.xxhash64(*spread_by)
    part = F.when(F.col(key).isNull(), F.pmod(deal, F.lit(NULL_PARTS)) + parts).otherwise(F.pmod(deal, F.lit(parts)))
    dealt = left.withColumn("_part", part.cast("int"))
    repeated = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(repeated, [key, "_part"], "left").drop("_part")


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[Column], parts: int = PARTS) -> DataFrame:
    """Inner join of two sides that may both have many rows per key, without a hot task.

    For a ``right`` side with few rows of each key: left rows are dealt out
    over ``parts`` by a hash of ``spread_by`` and each right row is repeated
    for every part, so that the pairs of a hot key are made by ``parts``
    tasks, each pair once.  Rows without a key meet nothing and are left out
    before they move.
    """
    known = lambda df: df.dropna(subset=keys)
    dealt = known(left).withColumn("_part", F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int"))
    repeated = known(right).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(repeated, [*keys, "_part"]).drop("_part")
