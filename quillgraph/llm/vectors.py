"""Vectors in shards, and queries sent to every shard in blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 4096, 2048


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", zero: bool = False) -> DataFrame:
    """The vectors that take part: ``(vec_id, vec, dim)``.

    Null ids and vectors, empty ones and those with a null or non-finite
    component are left out, and zero vectors unless ``zero``. Of several rows
    with one id, the smallest vector counts.
    """
    x = F.col("vec")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
    if not zero:
        rows = rows.filter(F.exists(x, lambda e: e != 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def shards(n: int, size: int = SHARD) -> int:
    return max(1, math.ceil(n / size))


def placed(rows: DataFrame, n: int) -> Column:
    """The shard of a row, by hash of its id."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")


def to_all(queries: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """Queries once for each shard, with the block they belong to."""
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_blocks)).cast("int"))
    return blocked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The ``k`` first of each query by ``order``, ties to the smaller vec_id: ``(query_id, rank, vec_id, score)``."""
    by = Window.partitionBy("query_id").orderBy(order, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of rows that have vectors of one length, ordered by id."""
    ids = rows.column("vec_id").to_numpy()
    flat = rows.column("vec").combine_chunks()
    flat = flat.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order] if len(ids) else np.zeros((0, 0))
