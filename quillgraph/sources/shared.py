"""Where checkpoints and intermediate tables go."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, ready for ``DataFrame.checkpoint``.

    Taken from ``spark.checkpoint.dir`` or from a checkpoint directory set on
    the context. Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None)
    if folder is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {SETTING} to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="quillgraph-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, as ``quillgraph.llm`` does."""
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def let_go(spark: SparkSession) -> None:
    """Have the driver drop the shuffle files and checkpoints that nothing refers to any more.

    Spark removes these when the driver's garbage collection finds them
    unused, which in a large heap may be long after. What Python lets go of
    reaches the driver a little later, so it looks twice.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def packed_checkpoint(df: DataFrame) -> DataFrame:
    """The rows as ``DataFrame.checkpoint`` keeps them, compressed, in the same partitions and order.

    A plain checkpoint holds each row as it is in memory, which for short
    columns is several times what they need.
    """
    reach_workers(df.sparkSession)
    shared_dir(df.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_pydict({"batch": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column(0):
                yield from pa.ipc.open_stream(held.as_buffer())

    return df.mapInArrow(pack, "batch binary").checkpoint().mapInArrow(unpack, df.schema)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class WorkFolder:
    """A folder below the shared one for the tables and streams of one job."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.path = work_path(spark, "work")

    def at(self, name: str) -> str:
        """A new path in the folder."""
        return f"{self.path}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows, frozen by a checkpoint that outlives the folder.

        The folder's tables are read for the last time here; executors that
        are lost later read the checkpoint again.
        """
        return packed_checkpoint(df)

    def drop(self) -> None:
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[WorkFolder]:
    """A scoped work folder: all that was written to it goes when the block ends, by an error too.

    What the block returns should have passed :meth:`WorkFolder.keep`. Its
    checkpoint, like those of the operators, is removed when nothing refers to
    it any more, if the session was started with
    ``spark.cleaner.referenceTracking.cleanCheckpoints=true``.
    """
    folder = WorkFolder(spark)
    try:
        yield folder
    finally:
        folder.drop()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Plans that run inside the block follow these settings. They are the session's, so they hold for all its threads."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffle_partitions(spark: SparkSession, n: int) -> AbstractContextManager[None]:
    """Plans that run inside the block shuffle to ``n`` partitions."""
    return session_settings(spark, {"spark.sql.shuffle.partitions": str(n)})
