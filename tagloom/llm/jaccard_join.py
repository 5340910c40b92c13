"""Join documents whose word shingles are alike, pruning candidates by the posterior of their similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.arrays import merge, mixed, segment_hashes, slices, utf8, window_hashes, word_hashes, words_of
from tagloom.llm.shared import components, stage

WORDS, THRESHOLD = 5, 0.8
HASHES, BANDS, ROWS, STEP = 64, 16, 2, 16
TOLERANCE = 1e-7
TILE = 512
_RANDOM = np.random.default_rng(7)
_FLIP, _TIMES = (_RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64) for _ in range(2))
_TIMES = _TIMES * np.uint64(2) + np.uint64(1)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin.

    A text of fewer words, but at least one, has a single shingle of them all.
    """
    data, offsets = utf8(column)
    starts, ends, before = words_of(data, offsets)
    hashes = word_hashes(data, starts, ends)
    whole = window_hashes(hashes, words)
    first = np.arange(len(whole))
    text = np.searchsorted(before, first, "right") - 1
    inside = first + words <= before[text + 1]
    counts = np.diff(before)
    short = np.flatnonzero((counts > 0) & (counts < words))
    values = np.concatenate([whole[inside], segment_hashes(hashes, before[short], before[short + 1])])
    owner = np.concatenate([text[inside], short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(len(column) + 1))


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of compared values, the fewest matches with which a pair stays.

    With a uniform prior, m matches among n values give the similarity a
    Beta(m + 1, n - m + 1) posterior.  The chance that it reaches the threshold
    equals that of at most m successes in n + 1 trials; below ``tolerance`` the
    pair is dropped.
    """
    t, out = Fraction(threshold).limit_denominator(10**6), []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = Fraction(0), -1
        while m < n:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= tolerance:
                break
        out.append(m)
    return out


def likely(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Indices of the row pairs that stay after comparing their values step by step."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int16)
    for i, need in enumerate(least):
        part = slice(i * STEP, (i + 1) * STEP)
        matches = matches + (left[alive, part] == right[alive, part]).sum(1, dtype=np.int16)
        stays = matches >= need
        alive, matches = alive[stays], matches[stays]
    return alive


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of sorted rows, many at a time, and where each group begins."""
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(last: bool):
        nonlocal held, count
        whole = pa.Table.from_batches(held).combine_chunks()
        step = np.zeros(whole.num_rows, bool)
        for key in keys:
            values = whole.column(key).to_numpy()
            step[1:] |= values[1:] != values[:-1]
        begins = np.concatenate([[0], np.flatnonzero(step), [whole.num_rows]])
        if not last:
            begins = begins[:-1]
        end = int(begins[-1])
        rest = whole.slice(end)
        held, count = rest.to_batches(), rest.num_rows
        return whole.slice(0, end), begins

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= rows:
            table, begins = cut(False)
            if table.num_rows:
                yield table, begins
    if count:
        yield cut(True)


def tiled(rows: DataFrame, key: str, size: str, member: str, tile: int) -> DataFrame:
    """Deal the members of each key into blocks of about ``tile`` rows and repeat them for each pair of blocks.

    Adds ``i, j, side``; a group of at most ``tile`` rows is one block and not
    repeated.
    """
    blocks = F.ceil(F.col(size) / F.lit(tile)).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(3)), blocks).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("own") <= F.col("other"), 0).otherwise(1))
        .drop("own", "other", size)
        .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")
    )


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, shingles, low, high, signature``: size, 128-bit hash and MinHash values of each document's set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                values, begins = shingles(cut.column("text"), words)
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                at = begins[:-1][full]
                least = np.full((len(sizes), HASHES), 0xFFFFFFFF, np.uint32)
                sums = np.zeros((2, len(sizes)), np.uint64)
                if len(at):
                    for k in range(HASHES):
                        least[full, k] = np.minimum.reduceat((((values ^ _FLIP[k]) * _TIMES[k]) >> np.uint64(32)).astype(np.uint32), at)
                    sums[0, full] = np.add.reduceat(mixed(values), at)
                    sums[1, full] = np.add.reduceat(mixed(values ^ np.uint64(0x5DEECE66D)), at)
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), pa.array(sizes), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                     pa.array([row.tobytes() for row in least], pa.binary())],
                    ["doc_id", "shingles", "low", "high", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, shingles long, low long, high long, signature binary"
    )


def values_of(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint32).reshape(len(rows), HASHES)


def likely_links(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Links ``a, b`` that join the classes of every pair which survives the pruning.

    Candidates share a band of two MinHash values; at a similarity of 0.8 a
    pair shares none of 16 bands with a chance of 1 in 12 million.  Only bands
    that two classes share carry signatures on.  A band that many share is
    dealt into tiles.  Each run of groups sends back one link per class and not
    its pairs.
    """
    least = least_matches(threshold, tolerance)

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = values_of(batch.column("signature"))[:, : BANDS * ROWS].astype(np.uint64)
            keys = mixed(values[:, ::2] | values[:, 1::2] << np.uint64(32))
            keys = mixed(keys + np.arange(BANDS, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column("doc_id").to_numpy(), BANDS))], ["band", "doc_id"]
            )

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in groups(batches, ["band", "i", "j"]):
            values, ids = values_of(table.column("signature")), table.column("doc_id").to_numpy()
            side, across = table.column("side").to_numpy(), table.column("i").to_numpy() != table.column("j").to_numpy()
            group = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
            label = np.arange(len(ids))
            for step in range(1, int(np.diff(begins).max())):
                a = np.flatnonzero(group[step:] == group[:-step])
                b = a + step
                meets = (ids[a] != ids[b]) & (~across[a] | (side[a] != side[b])) & (label[a] != label[b])
                a, b = a[meets], b[meets]
                for at in range(0, len(a), 1 << 15):
                    x, y = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
                    stay = likely(values[x], values[y], least)
                    merge(label, x[stay], y[stay])
            linked = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], ["a", "b"])

    keys = stage(classes.select("doc_id", "signature").mapInArrow(bands, "band long, doc_id long"), "bands")
    shared = keys.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    rows = keys.join(shared, "band").join(classes.select("doc_id", "signature"), "doc_id")
    return tiled(rows, "band", "members", "doc_id", TILE).mapInArrow(prune, "a long, b long")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each pair of sets has in common, by products of their incidence matrices."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    held = times[place] > 1
    owner, place = owner[held], column[place[held]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], place[a:b] - at] = 1
        out += part @ part.T
    return out


def exact_links(docs: DataFrame, classes: DataFrame, near: DataFrame, words: int, threshold: float) -> DataFrame:
    """``doc_id, met, root`` for each class: how many documents of other classes it links with, and one link.

    ``near`` names the group of each class.  Only their texts are read again;
    all pairs of a group are compared by their shingle sets, in tiles.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch):
                values, begins = shingles(cut.column("text"), words)
                packed = [values[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [cut.column("component"), cut.column("doc_id"), cut.column("copies"), cut.column("members"), pa.array(packed, pa.binary())],
                    ["component", "doc_id", "copies", "members", "packed"],
                )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in groups(batches, ["component", "i", "j"], 2 * TILE):
            ids, copies = table.column("doc_id").to_numpy(), table.column("copies").to_numpy()
            side, packed = table.column("side").to_numpy(), table.column("packed").to_pylist()
            across = table.column("i").to_numpy() != table.column("j").to_numpy()
            met, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                own = [np.frombuffer(p, np.uint64) for p in packed[a:b]]
                sizes = np.array([len(s) for s in own])
                both = intersections(own)
                alike = both / (sizes[:, None] + sizes - both) >= threshold
                if across[a]:
                    alike &= side[a:b, None] != side[a:b]
                else:
                    np.fill_diagonal(alike, False)
                met[a:b] += alike.astype(np.int64) @ copies[a:b]
                x, y = np.nonzero(np.triu(alike))
                merge(label, x + a, y + a)
            linked = np.flatnonzero(met)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(met[linked]), pa.array(ids[label[linked]])], ["doc_id", "met", "root"]
            )

    sizes = near.groupBy("component").agg(F.count("*").alias("members"))
    named = near.join(sizes, "component").join(classes.select(F.col("doc_id").alias("node"), "copies", "low", "high"), "node")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        named.select(F.col("node").alias("doc_id"), "component", "copies", "members"), "doc_id"
    )
    packed = texts.mapInArrow(sets, "component long, doc_id long, copies long, members long, packed binary")
    return tiled(packed, "component", "members", "doc_id", TILE).mapInArrow(verify, "doc_id long, met long, root long")


def near_copies(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """``doc_id, n_shingles, class_id, n_links`` for each row of ``docs(doc_id, text)``.

    Two documents link if the Jaccard similarity of their sets of ``words``
    consecutive words reaches ``threshold``.  ``class_id`` is the smallest id
    that links lead to, ``n_links`` the number of other documents linked
    directly.  Documents with equal sets are one class and never expanded into
    pairs; classes that survive the pruning are compared exactly.

    Null, empty and blank texts have no shingles and link with nothing; a text
    of one to four words has one shingle.  Rows without an id are returned
    with a null class and no links.  ``doc_id`` is expected to name one row;
    rows that share one with equal sets count as copies.  Other columns are
    ignored; an empty table gives no rows.
    """
    signed = stage(signatures(docs, words), "signatures")
    full = signed.where("shingles > 0 and doc_id is not null")
    classes = stage(
        full.groupBy("low", "high", "shingles").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("signature").alias("signature")
        ),
        "classes",
    )
    near = components(likely_links(classes, threshold, tolerance))
    met = stage(exact_links(docs, classes, near, words, threshold), "verified")
    final = components(met.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    counted = (
        classes.drop("signature")
        .join(met.groupBy("doc_id").agg(F.sum("met").alias("met")), "doc_id", "left")
        .join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "low", "high", "shingles", F.coalesce("component", "doc_id").alias("class_id"),
            (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    linked = full.select("doc_id", "low", "high", "shingles").join(counted, ["low", "high", "shingles"]).select(
        "doc_id", F.col("shingles").alias("n_shingles"), "class_id", "n_links"
    )
    alone = signed.where("shingles = 0 or doc_id is null").select(
        "doc_id", F.col("shingles").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return linked.union(alone)
