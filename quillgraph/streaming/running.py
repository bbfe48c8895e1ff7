"""The running word count on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quillgraph.operators.profiles import word_count

# Bytes of files that a micro-batch takes in, one file at least.
BATCH_BYTES = 64 << 30


def stream_table(spark: SparkSession, path: str, schema: StructType | str, batch_bytes: int | None = BATCH_BYTES) -> DataFrame:
    """The files of a Parquet table, or of all tables that a pattern names, as a stream.

    The table's own files are read where they lie, as many tasks as they have
    splits; a micro-batch takes files up to ``batch_bytes``, one at least, or
    all there are if that is None.
    """
    # A file source takes one file for a folder unless it is named by a pattern.
    folder, _, name = path.rstrip("/").rpartition("/")
    if not set("*?[]{}") & set(name):
        path = f"{folder}/{{{name}}}" if folder else f"{{{name}}}"
    reader = spark.readStream.schema(schema)
    if batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    return reader.parquet(path)


def running_word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """The word counts of a stream of lines, for output mode ``complete``: ``(word, n)``."""
    return word_count(lines, col)


def run_word_count(counts: DataFrame, checkpoint: str, sink: str = "noop", **options) -> None:
    """Work through all input that is available now and keep the counts as state.

    Each micro-batch hands the whole map to ``sink``. The default sink drops
    it: the state lies partitioned below ``checkpoint`` and is read with
    :func:`read_word_count`, so no result passes through the driver. A later
    run with the same checkpoint goes on from there.
    """
    writer = counts.writeStream.outputMode("complete").format(sink).options(checkpointLocation=checkpoint, **options)
    _finish(writer.trigger(availableNow=True).start())


def emit_word_count(counts: DataFrame, checkpoint: str, out: str) -> None:
    """As :func:`run_word_count`, and write the whole map after each micro-batch below ``out``.

    A batch has one folder, named by its number, which is overwritten: a batch
    that is run again after a failure replaces what it had written, so each
    map is there once. The map is written by the executors.
    """

    def emit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = counts.writeStream.outputMode("complete").foreachBatch(emit).option("checkpointLocation", checkpoint)
    _finish(writer.trigger(availableNow=True).start())


def read_emitted(spark: SparkSession, out: str) -> DataFrame:
    """The maps written so far: ``(batch, word, n)``."""
    return spark.read.schema("word string, n bigint, batch bigint").parquet(out).select("batch", "word", "n")


def read_word_count(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts as of the last micro-batch: ``(word, n)``."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.word", F.col("value.count").alias("n"))


def _finish(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()
