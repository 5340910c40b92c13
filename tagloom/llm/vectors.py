"""Vectors as packed bytes, for the operators that compare them in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key`` and the vector as doubles in ``packed``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    take no part, nor do those of another length than most vectors have (the
    shorter length among equally frequent ones) or rows without a key.  A
    component of -0.0 becomes 0.0, so equal vectors have equal bytes.
    """
    held = vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, column)
    lengths = held.groupBy(F.size(column).alias("length")).count()
    common = lengths.orderBy(F.desc("count"), "length").limit(1).first()
    length = common["length"] if common else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            fit = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False)) == length
            rows = np.flatnonzero(fit)
            lists = lists.take(pa.array(rows))
            flat = lists.flatten()
            matrix = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), length) + 0.0
            good = np.isfinite(matrix).all(1) & (matrix != 0).any(1)
            packed = [row.tobytes() for row in np.ascontiguousarray(matrix[good])]
            ids = batch.column(0).take(pa.array(rows[good]))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(packed, pa.binary())], ["vec_id", "packed"])

    if not length:
        return held.sparkSession.createDataFrame([], "vec_id long, packed binary")
    return held.mapInArrow(pack, "vec_id long, packed binary")


def matrix(packed: pa.Array | list[bytes]) -> np.ndarray:
    rows = packed if isinstance(packed, list) else packed.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that squares neither vanish nor overflow."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row products, summed from the first component on, so that every row's rounding is that of a plain loop."""
    out = np.zeros(len(left))
    for a, b in zip(np.ascontiguousarray(left.T), np.ascontiguousarray(right.T), strict=True):
        out += a * b
    return out


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, in double precision; very small or large rows are scaled first."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore", under="ignore"):
        lengths = _dots(left, left) * _dots(right, right)
        out = _dots(left, right) / np.sqrt(lengths)
    odd = ~((lengths > 1e-200) & (lengths < 1e200))
    if odd.any():
        a, b = unit(left[odd]), unit(right[odd])
        out[odd] = _dots(a, b)
    return np.clip(out, -1.0, 1.0)
