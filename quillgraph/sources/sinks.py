"""Text sinks: tab-separated tables, summaries and ranked lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tsv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column] | None = None,
    partitions: int | None = None,
    key: Sequence[str | Column] | None = None,
    mode: str = "errorifexists",
    compression: str | None = None,
) -> None:
    """Write the columns of ``df`` separated by tabs, sorted inside each part file.

    The order is that of the columns unless ``order_by`` names another. With
    ``partitions`` the rows are first spread over that many part files by
    ranges of the sort key, so a frequent key is not bound to one file; with
    ``key`` too they are spread by its hash, so a key is in one file.
    ``compression`` packs the part files, each of which one task then reads.
    """
    order = list(order_by) if order_by else list(df.columns)
    if partitions is not None:
        df = df.repartition(partitions, *key) if key else df.repartitionByRange(partitions, *order)
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    df.sortWithinPartitions(*order).select(F.concat_ws("\t", *fields).alias("value")).write.mode(mode).text(path, compression=compression)


def write_summaries(summaries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``doc_id``, a tab, the summary and a blank line per record."""
    record = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "summary", F.lit("\n"))
    summaries.select(record.alias("value")).write.mode(mode).text(path)


def format_ranked(ranked: DataFrame) -> DataFrame:
    """Lines ``rank - title`` of a ranked page list: ``(line)``."""
    return ranked.select(F.concat_ws(" - ", F.col("rank").cast("string"), "title").alias("line"))
