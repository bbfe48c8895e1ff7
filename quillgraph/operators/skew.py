"""Join a large table to one row per key when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that one key may bring to one task. Keys above it are hot, if they also
# hold more than a HOT_KEYS-th of all rows, of which there are fewer than HOT_KEYS.
HOT_ROWS = 1_000_000
HOT_KEYS = 500_000


def hot_keys(
    dims: DataFrame, key: Column, rows: str, hot_rows: int | None = None, hot_keys: int | None = None
) -> DataFrame:
    """The hot keys of a table with one row per key, fewer than ``hot_keys`` rows ``(key, parts)``.

    ``rows`` names the row count of each key, ``parts`` says into how many
    parts the key should be split. A key is hot with more than ``hot_rows``
    rows and more than a ``hot_keys``-th of all, so the list is bounded and
    holds every key that is.
    """
    per_part = HOT_ROWS if hot_rows is None else hot_rows
    most = HOT_KEYS if hot_keys is None else hot_keys
    total = dims.agg(F.sum(rows).alias("total")).scalar()
    hot = dims.filter(F.col(rows) > per_part).groupBy(key.alias("key")).agg(F.max(rows).alias("size"))
    hot = hot.filter(F.col("size") > total / F.lit(most))
    return hot.select("key", F.ceil(F.col("size") / per_part).cast("int").alias("parts"))


def salted_join(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    spread: str,
    rows: str,
    **limits: int,
) -> DataFrame:
    """Inner-join ``facts`` to ``dims`` on ``key``, splitting the hot keys.

    ``dims`` holds one row per key, with the number of its fact rows in the
    column ``rows``. The facts of a hot key are dealt out over its parts by
    the hash of ``spread`` and its one dimension row is repeated per part. All
    other keys stay whole. The list of hot keys holds 64-bit hashes, so that
    not only its length but its size is bounded; a hash collision only splits
    one key more, on both sides alike.
    """
    hot = F.broadcast(hot_keys(dims, F.xxhash64(key), rows, **limits)).withColumnsRenamed(
        {"key": "_hash", "parts": "_parts"}
    )
    dealt = (
        facts.withColumn("_hash", F.xxhash64(key))
        .join(hot, "_hash", "left")
        .withColumn("_part", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")), F.lit(0)).cast("int"))
        .drop("_hash", "_parts")
    )
    repeated = (
        dims.withColumn("_hash", F.xxhash64(key))
        .join(hot, "_hash", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_hash", "_parts")
    )
    return dealt.join(repeated, [key, "_part"]).drop("_part")
