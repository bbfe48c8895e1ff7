"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import bisect
import gc
import os
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a maximal run of characters other than ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
_WORDS = re.compile(WORD)


def words(text: str) -> list[str]:
    return _WORDS.findall(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    That is a folder all workers see in a local session or on a shared disk;
    on other clusters the package is installed or shipped with ``--py-files``,
    and the folder does no harm.
    """
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def spare_memory(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers of this session give memory back, and hand them few rows at a time.

    For jobs of many stages, whose workers live on from stage to stage: large
    arrays are mapped by themselves and unmapped when freed, and a batch of
    long texts is not held in full by the JVM and by Python. Settings that the
    session's user has made stay.
    """
    reach_workers(spark)
    for name, value in (("MALLOC_ARENA_MAX", "2"), ("MALLOC_MMAP_THRESHOLD_", "1048576"), ("MALLOC_TRIM_THRESHOLD_", "1048576"), ("ARROW_DEFAULT_MEMORY_POOL", "system")):
        spark.sparkContext.environment.setdefault(name, value)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, rows)


def let_go(spark: SparkSession) -> None:
    """Have the driver drop what ended jobs left: broadcasts, shuffle files and checkpoints that nothing refers to.

    For jobs of many small ones. Spark removes these when the driver's garbage
    collection finds them unused, and a driver lets its heap grow to the limit
    before it looks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: pa.Array, limit: int) -> list[tuple[int, int]]:
    """Row ranges of a string or binary column, each of about ``limit`` bytes, one row at least."""
    if not len(texts):
        return []
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].tolist()
    cuts, start = [], 0
    while start < len(texts):
        stop = min(len(texts), max(start + 1, bisect.bisect_right(ends, ends[start] + limit) - 1))
        cuts.append((start, stop))
        start = stop
    return cuts


def fold(doc_id: Column, folds: int) -> Column:
    """The crc32 of an id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """At most ``bound`` labelled documents as ``(doc_id, text, label)``, the same ones in every run.

    ``train`` says, over ``doc_id``, which labels may be learned from. Ids with
    contradictory labels are left out, repeated labels count once. The sample
    is the start of the ids ordered by hash, so its size does not grow with
    the data and its ids may be broadcast.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("doc_id", "label")
    )
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
