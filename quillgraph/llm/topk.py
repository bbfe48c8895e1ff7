"""Exact top-k inner products by norm-sorted, rotated partial sums.

Vectors of a shard are read by descending length. A rotation by the singular
vectors gathers most of a product in its first components; what the others can
add is at most the product of the residual lengths, by Cauchy and Schwarz.
Only vectors whose bound reaches a query's k-th score are multiplied in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm import vectors as vx
from quillgraph.llm.common import reach_workers

#: Vectors that are bounded together.
STRIP = 256
FOUND = "query_id bigint, vec_id bigint, score bigint"


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Components x of ``vec`` as the whole numbers floor(scale * x)."""
    return vectors.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))


def search_shard(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, strip: int = STRIP):
    """The ``k`` largest inner products of each query with rows of other ids, ties to the smaller id.

    Whole numbers in, exact scores out: sums below 2**53 are exact in double
    precision, larger ones are added up as 64-bit integers. Returns query
    positions, row ids and scores.
    """
    n, m = len(rows), len(queries)
    top_scores = np.full((m, k), -np.inf)
    top_ids = np.full((m, k), np.iinfo(np.int64).max)
    if n and m:
        exact = float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1] < 2.0**53
        lengths = np.sqrt((rows**2).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        ids, rows, lengths = ids[order], rows[order], lengths[order]
        _, turn = np.linalg.eigh(rows.T @ rows)
        turn = turn[:, ::-1]
        head = max(1, rows.shape[1] // 4)
        turned, turned_queries = rows @ turn, queries @ turn
        rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        rest_queries = np.sqrt((turned_queries[:, head:] ** 2).sum(axis=1))
        long_queries = np.sqrt((queries**2).sum(axis=1))
        slack = 1e-9 * (1 + long_queries * lengths[0])
        for start in range(0, n, strip):
            part = slice(start, min(n, start + strip))
            open_queries = np.flatnonzero(long_queries * lengths[start] + slack >= top_scores[:, -1])
            if not len(open_queries):
                break
            bound = turned_queries[open_queries, :head] @ turned[part, :head].T
            bound += rest_queries[open_queries, None] * rest[None, part] + slack[open_queries, None]
            reach = bound >= top_scores[open_queries, -1:]
            own = query_ids[open_queries, None] == ids[None, part]
            reach &= ~own
            some = np.flatnonzero(reach.any(axis=1))
            if not len(some):
                continue
            who, columns = open_queries[some], np.flatnonzero(reach[some].any(axis=0))
            candidates = rows[part][columns]
            if exact:
                scores = queries[who] @ candidates.T
            else:
                scores = (queries[who].astype(np.int64) @ candidates.astype(np.int64).T).astype(object)
            scores = np.where(reach[some][:, columns], scores, -np.inf)
            both = np.concatenate([top_scores[who], scores], axis=1)
            names = np.concatenate([top_ids[who], np.broadcast_to(ids[part][columns], scores.shape)], axis=1)
            if both.dtype == object:
                top_scores = top_scores.astype(object)
                pick = np.array([sorted(range(both.shape[1]), key=lambda j, b=b, i=i: (-b[j], i[j]))[:k] for b, i in zip(both, names, strict=True)])
            else:
                pick = np.lexsort((names, -both), axis=1)[:, :k]
            top_scores[who] = np.take_along_axis(both, pick, axis=1)
            top_ids[who] = np.take_along_axis(names, pick, axis=1)
    at, column = np.nonzero(top_scores != -np.inf)
    return at, top_ids[at, column], top_scores[at, column]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = vx.SHARD, block: int = vx.BLOCK) -> DataFrame:
    """The ``k`` largest inner products of every query: ``(query_id, rank, vec_id, score)``.

    ``vectors`` and ``queries`` are ``(vec_id, vec, dim)`` of whole numbers, as
    :func:`quantized` makes them; a query's own id is no candidate. Only
    vectors as long as the query are. All candidates come back where there
    are fewer than ``k``; empty tables give no rows. Scores must fit a 64-bit
    integer. Vectors are spread over shards by hash and queries over blocks,
    so a task holds one shard and one block; each shard returns ``k`` rows a
    query, which are merged.
    """
    reach_workers(vectors.sparkSession)
    n_shards, n_blocks = vx.shards(vectors.count(), shard), vx.shards(queries.count(), block)
    rows = vectors.withColumn("shard", vx.placed(vectors, n_shards))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = vx.to_all(queries, n_shards, n_blocks)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids, wanted = vx.matrix(right)
        ids, held = vx.matrix(left)
        at, found, scores = search_shard(ids, held, query_ids, wanted, k)
        whole = [int(x) for x in scores]
        return pa.table({"query_id": pa.array(query_ids[at], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(whole, pa.int64())})

    keys = ["dim", "shard", "block"]
    found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)
    return vx.best(found, k, F.desc("score"))
