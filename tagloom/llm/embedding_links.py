"""Near-duplicate embeddings by PCA-ordered tiles that stop when the cosine cannot reach the threshold."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.arrays import merge
from tagloom.llm.shared import components, stage
from tagloom.llm.vectors import cosines, matrix, unit, usable

BLOCK = 4096
BASIS_ROWS = 8192
STEPS = (8, 16, 32)


def leading_axes(rows: DataFrame) -> np.ndarray | None:
    """Axes by falling second moment, from a sample of at most ``BASIS_ROWS`` rows with the smallest id hashes.

    Any orthonormal basis gives the same links; the sample only decides how
    early the comparison stops.
    """
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(BASIS_ROWS).select("packed").toPandas()["packed"]
    if not len(sample):
        return None
    near = unit(matrix(sample.tolist()))
    values, axes = np.linalg.eigh(near.T @ near)
    return axes[:, np.argsort(values)[::-1]]


def linked_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float, run: int = 512):
    """Pairs of rows with a cosine of ``threshold`` or more, as runs of index arrays.

    Coordinates in the axes are summed from the leading ones on.  What the
    other axes can still add is at most the product of the suffix norms; a run
    of rows whose sums plus bounds all stay below the threshold stops there.
    Rows are sorted by their first coordinate, which rules out whole pairs of
    runs before any product.
    """
    a, b = unit(left) @ axes, unit(right) @ axes
    by_a, by_b = np.argsort(a[:, 0], kind="stable"), np.argsort(b[:, 0], kind="stable")
    a, b = a[by_a].astype(np.float32), b[by_b].astype(np.float32)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-4
    steps = [s for s in STEPS if s < a.shape[1]] + [a.shape[1]]
    rest_a = [np.sqrt((a[:, s:].astype(np.float64) ** 2).sum(1)).astype(np.float32) for s in steps]
    rest_b = [np.sqrt((b[:, s:].astype(np.float64) ** 2).sum(1)).astype(np.float32) for s in steps]
    for at in range(0, len(a), run):
        part = slice(at, at + run)
        low = np.searchsorted(b[:, 0], a[part][0, 0] - reach)
        high = np.searchsorted(b[:, 0], a[part][-1, 0] + reach, "right")
        for b_at in range(low, high, 4 * run):
            other = slice(b_at, min(high, b_at + 4 * run))
            sums, begin = np.zeros((len(a[part]), len(b[other])), np.float32), 0
            alive = None
            for step, (ra, rb) in zip(steps, zip(rest_a, rest_b, strict=True), strict=True):
                sums += a[part, begin:step] @ b[other, begin:step].T
                begin = step
                alive = sums >= (threshold - 1e-4) - ra[part][:, None] * rb[other]
                if not alive.any():
                    break
            else:
                i, j = np.nonzero(alive)
                i, j = by_a[i + at], by_b[j + b_at]
                for cut in range(0, len(i), 1 << 16):
                    x, y = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
                    exact = cosines(left[x], right[y]) >= threshold
                    if exact.any():
                        yield x[exact], y[exact]


def links(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Equal vectors are one class and meet once, so a vector that fills a third
    of the table costs one comparison.  Classes are dealt into even blocks by
    hash; each pair of blocks is a tile, which sends back one row per linked
    class: how many vectors it met and one link into its group.  No pair is
    ever written.  Groups come from ``components``.

    Unusable vectors (see ``usable``) link with nothing and are their own
    component; so is a row without an id, with null.  Rows that repeat an id
    are reported once each, all linked with one another's classes.
    """
    rows = stage(usable(vectors), "vectors")
    classes = stage(rows.groupBy("packed").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "classes")
    axes = leading_axes(classes)
    if axes is None:
        return vectors.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    blocks = max(1, math.ceil(classes.count() / BLOCK))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        first = group["side"].to_numpy() == 0
        ids, copies = group["vec_id"].to_numpy(), group["copies"].to_numpy()
        spread = np.arange(len(ids))
        counts = np.zeros(len(ids), np.int64)
        same = key[0] == key[1]
        left = np.flatnonzero(first)
        right = left if same else np.flatnonzero(~first)
        if len(left) and len(right):
            packed = group["packed"]
            a = matrix(packed.iloc[left].tolist())
            b = a if same else matrix(packed.iloc[right].tolist())
            for x, y in linked_pairs(a, b, axes, threshold):
                if same:
                    x, y = x[x < y], y[x < y]
                x, y = left[x], right[y]
                np.add.at(counts, x, copies[y])
                np.add.at(counts, y, copies[x])
                merge(spread, x, y)
        met = counts > 0
        root = pd.Series(ids).groupby(spread).transform("min").to_numpy()
        return pd.DataFrame({"vec_id": ids[met], "met": counts[met], "root": root[met]})

    block = F.pmod(F.xxhash64("packed"), F.lit(blocks)).cast("int")
    dealt = classes.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = dealt.select(
        F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        F.when(F.col("block") <= F.col("with"), 0).otherwise(1).alias("side"), "vec_id", "copies", "packed",
    )
    met = stage(tiles.groupBy("i", "j").applyInPandas(compare, "vec_id long, met long, root long"), "met")
    groups = components(met.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counted = classes.join(met.groupBy("vec_id").agg(F.sum("met").alias("met")), "vec_id", "left").join(
        groups.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    )
    known = rows.join(
        counted.select(
            "packed",
            (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        ),
        "packed",
    ).select("vec_id", "n_links", "component_id")
    plain = vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    alone = plain.join(rows.select("vec_id").distinct(), "vec_id", "left_anti")
    return known.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
