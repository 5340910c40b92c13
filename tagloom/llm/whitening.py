"""Whiten vectors by their leading principal components, found by slicing the spectrum of the covariance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import stage

COMPONENTS, SCALE = 4, 256
MOST = 1 << 31  # entries are held within +-MOST steps
BATCH = 4096
_PIVOT = (1 + math.sqrt(17)) / 8


# --- the spectrum, on the driver: one matrix of the vectors' length squared ------------


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues are negative, zero and positive, by an LDL' factorisation with 1x1 and 2x2 pivots.

    By Sylvester's law of inertia these are the signs of D; pivots are chosen
    as Bunch and Kaufman do, so that the factors stay small.
    """
    a = np.array(matrix, float)
    size, at, signs = len(a), 0, [0, 0, 0]

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while at < size:
        column = np.abs(a[at + 1 :, at])
        if not column.size or column.max() == 0:
            signs[int(np.sign(a[at, at])) + 1] += 1
            at += 1
            continue
        other = at + 1 + int(column.argmax())
        largest = column.max()
        rest = np.abs(a[other, at:])
        rest[other - at] = 0
        beyond = rest.max()
        if abs(a[at, at]) * beyond >= _PIVOT * largest**2:
            width = 1
        elif abs(a[other, other]) >= _PIVOT * beyond:
            swap(at, other)
            width = 1
        else:
            swap(at + 1, other)
            width = 2
        tail = a[at + width :, at : at + width]
        block = a[at : at + width, at : at + width]
        if width == 1:
            signs[int(np.sign(block[0, 0])) + 1] += 1
            a[at + 1 :, at + 1 :] -= np.outer(tail[:, 0], tail[:, 0] / block[0, 0])
        else:
            signs[0] += 1  # such a block has a negative determinant
            signs[2] += 1
            a[at + 2 :, at + 2 :] -= tail @ np.linalg.solve(block, tail.T)
        at += width
    return signs[0], signs[1], signs[2]


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[2]


class Component(NamedTuple):
    value: float
    vector: np.ndarray
    certified: bool


def _refined(matrix: np.ndarray, low: float, high: float, known: list[Component], seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair in ``low .. high``: inverse steps at the middle, then Rayleigh quotient steps, which converge cubically."""
    size = len(matrix)
    basis = np.array([c.vector for c in known]).reshape(len(known), size)

    def clear(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - basis.T @ (basis @ x)
        return x / np.linalg.norm(x)

    vector = clear(np.random.default_rng(seed).standard_normal(size))
    shift, scale = (low + high) / 2, max(abs(low), abs(high), np.finfo(float).tiny)
    best, least = vector, math.inf
    for step in range(40):
        try:
            moved = np.linalg.solve(matrix - shift * np.eye(size), vector)
        except np.linalg.LinAlgError:
            moved = np.linalg.solve(matrix - (shift + 4 * np.finfo(float).eps * scale) * np.eye(size), vector)
        if not np.isfinite(moved).all():
            break
        vector = clear(moved)
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if residual < least:
            best, least = vector, residual
        elif step > 6:
            break  # as near as rounding allows
        shift = value if step >= 2 and low < value < high else shift
    return float(best @ matrix @ best), best


def leading(matrix: np.ndarray, count: int = COMPONENTS) -> list[Component]:
    """The ``count`` largest eigenpairs of a covariance, fewer if it has fewer positive eigenvalues beyond rounding.

    Counts of eigenvalues above a shift halve the interval of each until it
    holds that one alone and is narrow against its distance from the others;
    the pair found inside is certified by two more counts around its value.
    Eigenvalues that agree to rounding cannot be told apart: each then gets a
    direction of their common space, orthogonal to those before, uncertified.
    The largest entry of a vector is positive.
    """
    size = len(matrix)
    top = float(np.abs(matrix).sum(1).max(initial=0))
    if not size or top == 0:
        return []
    noise = size * np.finfo(float).eps * top
    out: list[Component] = []
    for number in range(1, min(count, size) + 1):
        low, high = 0.0, top * (1 + 1e-9) + noise
        if above(matrix, noise) < number:
            break
        low = noise
        while True:  # the number-th largest lies in low .. high
            alone = above(matrix, high) == number - 1 and above(matrix, low) == number
            if high - low <= 4 * noise or alone and high - low <= 0.05 * high:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(matrix, middle) >= number else (low, middle)
        while True:
            value, vector = _refined(matrix, low, high, out, number)
            if low <= value <= high or high - low <= 4 * noise:
                break
            middle = (low + high) / 2  # the iteration left for a neighbour: narrow on
            low, high = (middle, high) if above(matrix, middle) >= number else (low, middle)
        if out and value > out[-1].value:
            value = out[-1].value  # equal to rounding
        certified = above(matrix, value - 4 * noise) == number and above(matrix, value + 4 * noise) == number - 1
        vector = vector * (1.0 if vector[np.abs(vector).argmax()] > 0 else -1.0)
        out.append(Component(value, vector, certified))
    return out


# --- the passes over the vectors ------------------------------------------------------


def stepped(vectors: DataFrame, key: str, column: str, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``steps``, the packed integers ``floor(scale * entry)``, of the vectors that take part."""
    held = vectors.where(F.col(column).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    lengths = held.groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), "length").limit(1).first()
    length = common["length"] if common else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            rows = np.flatnonzero(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False)) == length)
            flat = lists.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            entries = flat.reshape(len(rows), length)
            good = np.isfinite(entries).all(1)
            with np.errstate(over="ignore"):
                steps = np.clip(np.floor(scale * entries[good]), -MOST, MOST).astype(np.int64)
            packed = [row.tobytes() for row in np.ascontiguousarray(steps)]
            ids = batch.column(0).take(pa.array(rows[good]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], ["vec_id", "steps"])

    if not length:
        return held.sparkSession.createDataFrame([], "vec_id long, steps binary")
    return held.mapInArrow(pack, "vec_id long, steps binary")


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), -1)


def _moments(vectors: DataFrame, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """Exact sums over ``steps``: of each entry, or of the products of entries less ``centre``.

    Each task sums integers and sends what fits in 128 bits; Spark adds them.
    The driver gets one row for each entry, or pair of entries, of a vector.
    """
    middle = None if centre is None else np.array(centre, np.int64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                rows = _rows(batch.column(0).slice(at, BATCH))
                if middle is None:
                    part = rows.sum(0)[:, None]
                else:
                    rows = rows - middle
                    most = int(np.abs(rows).max(initial=0))
                    if most * most * len(rows) < 2**53:
                        part = rows.astype(float).T @ rows.astype(float)  # whole numbers below 2**53: exact
                        part = part.astype(np.int64)
                    else:
                        low = rows & 0x3FFFF  # eighteen bits, so that sums of products stay in 64
                        high = rows >> 18
                        cross = (high.T @ low).astype(object)
                        part = (high.T @ high).astype(object) * 2**36 + (cross + cross.T) * 2**18 + (low.T @ low).astype(object)
                total = part.astype(object) if total is None else total + part
        if total is not None:
            i, j = np.nonzero(np.triu(np.ones(total.shape, bool))) if middle is not None else (np.arange(len(total)), np.zeros(len(total), int))
            values = [str(total[a, b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(values)], ["i", "j", "value"])

    parts = vectors.select("steps").mapInArrow(sums, "i int, j int, value string")
    summed = parts.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {(r.i, r.j): int(r.value) for r in summed.toLocalIterator()}


class Model(NamedTuple):
    """What a fit gives: the number of different vectors, their sums, the total variance and the components."""

    n: int
    sums: list[int]
    trace: float
    components: list[Component]


def fit(different: DataFrame, count: int = COMPONENTS) -> Model:
    """The components of staged ``steps``, each vector once.

    The covariance is exact before it is rounded to doubles once: entries are
    centred on the mean rounded to an integer, products are summed as integers
    in any order, and the rest of the mean is taken off with whole fractions.
    So reruns agree to the bit, however the rows are dealt out.
    """
    n = different.count()
    if not n:
        return Model(0, [], 0.0, [])
    first = _moments(different, None)
    size = len(first)
    sums = [first[i, 0] for i in range(size)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    second = _moments(different, centre)
    matrix = np.zeros((size, size))
    for (i, j), total in second.items():
        matrix[i, j] = matrix[j, i] = float(Fraction(n * total - rest[i] * rest[j], n * n))
    trace = float(sum(Fraction(n * second[i, i] - rest[i] ** 2, n * n) for i in range(size)))
    return Model(n, sums, trace, leading(matrix, count))


def transform(model: Model):
    """Rows of steps to deviations and to whitened coordinates."""
    n, sums = model.n, np.array(model.sums, object)
    axes = np.array([c.vector / math.sqrt(c.value) for c in model.components])
    small = np.array(model.sums, np.int64) if max(map(abs, model.sums), default=0) < 2**62 else None

    def apply(rows: np.ndarray) -> tuple[list[int], np.ndarray]:
        most = int(np.abs(rows).max(initial=0))
        wide = small is None or n * most + int(np.abs(small).max(initial=0)) >= 2**62
        away = n * rows.astype(object) - sums if wide else n * rows - small
        largest = max((abs(int(v)) for v in (away.min(initial=0), away.max(initial=0))), default=0)
        squares = (away.astype(object) if largest * largest * rows.shape[1] >= 2**63 else away) ** 2
        return squares.sum(1).tolist(), (away / n).astype(float) @ axes.T

    return apply


def identity_error(different: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened fit rows' covariance minus the identity, from the rows themselves."""
    width = len(model.components)
    if not width:
        return 0.0
    apply = transform(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                white = apply(_rows(batch.column(0).slice(at, BATCH)))[1]
                total += white.T @ white  # their mean is zero: the mean was taken off exactly
        i, j = np.nonzero(np.ones(total.shape, bool))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], ["i", "j", "value"])

    parts = different.select("steps").mapInArrow(sums, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    off = F.abs(F.col("value") / model.n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(parts.agg(F.max(off)).first()[0])


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates: ``vec_id, component, n, deviation, whitened, value, explained, certified, identity_error``.

    An entry ``c`` becomes the integer ``floor(256 * c)``.  The fit takes each
    different vector once, so that copies weigh nothing: ``n`` of them.
    ``component`` runs from 1 by falling eigenvalue ``value`` of their
    covariance (divisor ``n``), ``explained`` is its share of the trace,
    ``deviation`` the exact sum of ``(n * x - S)**2`` over the entries (null if
    it leaves 64 bits) and ``whitened`` the centred vector along the
    component over the root of its eigenvalue.

    Vectors that are null, empty, or hold null or non-finite entries give no
    rows, nor do those of another length than most vectors have (the shorter
    among equally frequent ones).  Zero vectors take part.  Entries beyond
    ``2**31`` steps count as that.  Rows without a key stay, with a null.  A
    covariance without ``count`` eigenvalues above rounding (few or equal
    vectors) has fewer components, none at all with a single vector; then
    there are no rows.  Other columns are ignored; an empty table gives no rows.

    Only sums reach the driver: one for each pair of entries of a vector.
    """
    rows = stage(stepped(vectors, key, column), "steps")
    different = stage(rows.select("steps").distinct(), "different-steps")
    model = fit(different, count)
    shape = "vec_id long, component int, n long, deviation long, whitened double, value double, explained double, certified boolean, identity_error double"
    if not model.components:
        return rows.sparkSession.createDataFrame([], shape)
    error, apply, width = identity_error(different, model), transform(model), len(model.components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                away, white = apply(_rows(part.column(1)))
                count = part.num_rows
                places = pa.array(np.repeat(np.arange(count), width))
                tiled = lambda values, kind: pa.array(np.tile(np.array(values), count), kind)  # noqa: E731, B023
                held = pa.array([d if d < 2**63 else None for d in away], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(places), tiled(range(1, width + 1), pa.int32()), pa.array(np.full(count * width, model.n)), held.take(places),
                     pa.array(white.ravel()), tiled([c.value for c in model.components], pa.float64()),
                     tiled([c.value / model.trace for c in model.components], pa.float64()), tiled([c.certified for c in model.components], pa.bool_()),
                     pa.array(np.full(count * width, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "value", "explained", "certified", "identity_error"],
                )

    return rows.mapInArrow(project, shape)
