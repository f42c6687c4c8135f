"""Exact top-k inner product search with multi-resolution segment statistics.

A vector is cut into segments; each has a mean and a deviation.  Over segments of length L,
q . x <= sum L * (mean_q * mean_x + dev_q * dev_x), with equality only where the shapes agree, and
finer segments give a tighter bound.  (The same statistics bound the squared distance from below:
|q - x|^2 = |q|^2 + |x|^2 - 2 q . x.)  Bounds go from coarse to fine; a candidate that cannot reach
the k-th best exact score found so far is dropped, the rest are scored exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1, 4, 16)
BASE_BLOCK = 4096
QUERY_BLOCK = 1024


def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """id, v (floor(1024 x) of each component): vectors that are null, empty or hold a null or non-finite component are left out."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~bad)
        .select("vec_id", F.transform("x", lambda c: F.floor(c * 1024)).alias("v"))
    )


def _levels(m: np.ndarray) -> list[np.ndarray]:
    """For each level the statistics of all segments, scaled so that a bound is one matrix product."""
    out = []
    for parts in LEVELS:
        if parts > m.shape[1]:
            break
        cols = []
        for seg in np.array_split(m, parts, axis=1):
            root = np.sqrt(seg.shape[1])
            cols += [seg.mean(axis=1) * root, seg.std(axis=1) * root]
        out.append(np.stack(cols, axis=1))
    return out


def block_topk(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of the k best of this block for each query, its own row left out, ties to the smaller id."""
    order = np.argsort(xid, kind="stable")
    xid, x = xid[order], x[order]
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    ql, xl = _levels(qf), _levels(xf)
    coarse, out = ql[0] @ xl[0].T, []
    for i in range(len(qid)):
        other = np.flatnonzero(xid != qid[i])
        if not len(other):
            continue
        bound, floor = coarse[i, other], -np.inf
        if len(other) > k:  # the exact scores of the most promising give the first limit
            first = other[np.argpartition(-bound, k - 1)[: 4 * k]]
            floor = np.partition(x[first] @ q[i], -k)[-k] if len(first) >= k else -np.inf
        slack = 1e-6 * (1 + abs(floor)) if np.isfinite(floor) else 0.0
        left = other[bound >= floor - slack]
        for a, b in zip(ql[1:], xl[1:]):
            left = left[b[left] @ a[i] >= floor - slack]
            if len(left) > 4 * k:
                first = left[:: max(1, len(left) // (4 * k))]
                floor = max(floor, np.partition(x[first] @ q[i], -k)[-k])
        score = x[left] @ q[i]
        best = np.lexsort((xid[left], -score))[:k]
        out.append((np.full(len(best), qid[i]), xid[left][best], score[best]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out))


def exact_topk(rows: DataFrame, is_query: str, k: int = 10, vector: str = "embedding") -> DataFrame:
    """rows(vec_id, vector) -> query_id, rank, vec_id, score for each row that the SQL condition ``is_query`` picks.

    Queries and rows are dealt into blocks of bounded size and every query block meets every base
    block; a block pair gives at most k rows a query.  A query with fewer than k candidates gets
    them all.  Rows that repeat both id and vector count once; rows that share an id but not the
    vector are all candidates, and as a query the id gets the best over its vectors.  Only vectors
    of equal length are compared.  An empty table gives an empty result; other columns are not read.
    """
    base = quantised(rows, vector).dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v"))
    queries = base.where(is_query)
    n, m = base.count(), queries.count()
    nb, nq = max(1, -(-n // BASE_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    b = base.withColumn("bb", F.pmod(F.xxhash64("vec_id"), F.lit(nb)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    q = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(nq)).cast("int")).withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found = block_topk(left["vec_id"].to_numpy(), np.stack(left["v"].to_numpy()), right["vec_id"].to_numpy(), np.stack(right["v"].to_numpy()), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    keys = ("qb", "bb", "dim")
    near = q.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
