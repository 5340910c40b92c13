"""Nearest neighbours by a block matrix join over int8 products with error bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import stage
from tagloom.llm.vectors import cosines, matrix, unit, usable

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit rows, the scale of each row, and the length of what rounding lost."""
    scale = np.abs(rows).max(1) / 127.0
    codes = np.rint(rows / scale[:, None]).astype(np.int8)
    lost = rows - codes * scale[:, None]
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost))


def least_of_equals(ids: np.ndarray, packed: list[bytes], k: int) -> np.ndarray:
    """Rows to compare: of equal vectors only the k + 1 smallest ids can be among a query's k nearest."""
    order = sorted(range(len(ids)), key=lambda i: (packed[i], ids[i]))
    kept, seen, last = [], 0, None
    for i in order:
        seen = seen + 1 if packed[i] == last else 1
        last = packed[i]
        if seen <= k + 1:
            kept.append(i)
    return np.array(kept, np.int64)


def nearest_in_tile(q_ids, q_rows, c_ids, c_rows, k: int, run: int = 1024) -> Iterator[tuple[int, float, int]]:
    """The k nearest candidates of each query as ``(query, cosine, id)``.

    The product of two rows differs from that of their codes by at most
    ``lost_q + lost_c * (1 + lost_q)``.  Candidates whose upper bound is below
    the k-th best lower bound (or the k-th best cosine so far) cannot win; the
    others are compared in double precision and kept in a heap.
    """
    q_codes, q_scale, q_lost = quantised(unit(q_rows))
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    wide = np.float32 if q_rows.shape[1] * 127 * 127 < 1 << 24 else np.float64
    for at in range(0, len(c_ids), run):
        ids, rows = c_ids[at : at + run], c_rows[at : at + run]
        codes, scale, lost = quantised(unit(rows))
        near = (q_codes.astype(wide) @ codes.astype(wide).T) * (q_scale[:, None] * scale)
        slack = q_lost[:, None] + lost * (1 + q_lost[:, None]) + 1e-9
        near[q_ids[:, None] == ids] = -np.inf
        low = near - slack
        floor = np.partition(low, -k, 1)[:, -k] if len(ids) > k else np.full(len(q_ids), -np.inf)
        floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
        who, what = np.nonzero((near + slack >= floor[:, None]) & np.isfinite(near))
        for part in range(0, len(who), 1 << 16):
            a, b = who[part : part + (1 << 16)], what[part : part + (1 << 16)]
            for i, score, j in zip(a.tolist(), cosines(q_rows[a], rows[b]).tolist(), ids[b].tolist(), strict=True):
                entry = (score, -j)
                if len(heaps[i]) < k:
                    heapq.heappush(heaps[i], entry)
                elif entry > heaps[i][0]:
                    heapq.heapreplace(heaps[i], entry)
    for query, heap in zip(q_ids.tolist(), heaps, strict=True):
        for score, j in heap:
            yield query, score, -j


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Each query's ``k`` nearest other vectors by cosine: ``query_id, rank, vec_id, score``.

    Queries are the vectors whose id is divisible by ``every``; all vectors are
    candidates.  Both are dealt into even blocks by a hash of the id, and each
    pair of a query block and a candidate block is one group, so neither a
    frequent vector nor a cluster makes a group large.  The best of each tile
    (k rows a query) meet in a last ranking.  Unusable vectors take no part
    (see ``usable``); an empty table gives no rows; extra columns are ignored.
    The search is exact: recall is 1.  Rows that repeat an id count once for
    each row.
    """
    rows = stage(usable(vectors), "vectors")
    asks = F.col("vec_id") % every == 0
    counts = rows.agg(F.count("*").alias("all"), F.count_if(asks).alias("asked")).first()
    q_blocks = max(1, math.ceil(counts["asked"] / QUERY_BLOCK))
    c_blocks = max(1, math.ceil(counts["all"] / CANDIDATE_BLOCK))
    deal = F.xxhash64("vec_id", F.lit(1))

    def compare(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ask = group["asks"].to_numpy(bool)
        found: list[tuple[int, float, int]] = []
        if ask.any() and not ask.all():
            c_ids, c_packed = group["vec_id"].to_numpy()[~ask], group["packed"][~ask].tolist()
            kept = least_of_equals(c_ids, c_packed, k)
            c_rows = matrix([c_packed[i] for i in kept])
            q_ids, q_rows = group["vec_id"].to_numpy()[ask], matrix(group["packed"][ask].tolist())
            for at in range(0, len(q_ids), QUERY_BLOCK):
                part = slice(at, at + QUERY_BLOCK)
                found += nearest_in_tile(q_ids[part], q_rows[part], c_ids[kept], c_rows, k)
        return pd.DataFrame(found, columns=["query_id", "score", "vec_id"])

    queries = rows.where(asks).select(
        F.pmod(deal, F.lit(q_blocks)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c"),
        F.lit(True).alias("asks"), "vec_id", "packed",
    )
    candidates = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"),
        F.pmod(deal, F.lit(c_blocks)).cast("int").alias("c"), F.lit(False).alias("asks"), "vec_id", "packed",
    )
    best = queries.union(candidates).groupBy("q", "c").applyInPandas(compare, "query_id long, score double, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
