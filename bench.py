"""Time the headline queries; prints one JSON line.

A table in one small file is cut up by one task. So the queries are timed over
a copy of the tables in several files, which is written before the clock
starts, and after that over the tables as given; ``queries`` and ``value`` are
the former, ``single_file`` and ``single_file_value`` the latter.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
all cores), BENCH_RUNS (default 3; the median counts, so one cold run does not),
BENCH_SINGLE_RUNS (default 1, all warm; 0 leaves the tables as given out).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from quillgraph.plans.catalog import QUERIES

HEADLINE = (
    "word_count",
    "corpus_profile",
    "doc_profile",
    "tf_idf",
    "tf_idf_compat",
    "summaries",
    "parse_links",
    "pagerank_ideal",
    "pagerank_taxed",
    "link_bomb",
    "running_word_count",
)


#: What the headline queries read, and in how many files the copy is for each core.
TABLES = ("documents", "lineitem", "orders", "part")
FILES_PER_CORE = 2


def session(cpus: str, shared: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillgraph-bench")
        .config("spark.sql.shuffle.partitions", os.cpu_count() if cpus == "*" else cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.log.level", "ERROR")
    )
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def in_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The tables again, each in several files, rows dealt out in turn."""
    for name in TABLES:
        files = FILES_PER_CORE * spark.sparkContext.defaultParallelism
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def timed(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(os.environ.get("BENCH_CPUS", "*"), shared)
    seconds = timed(spark, in_files(spark, sf_dir, f"{shared}/tables"), int(os.environ.get("BENCH_RUNS", "3")))
    single_runs = int(os.environ.get("BENCH_SINGLE_RUNS", "1"))
    single = timed(spark, sf_dir, single_runs) if single_runs else {}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "files_per_table": FILES_PER_CORE * spark.sparkContext.defaultParallelism,
                "single_file": single,
                "single_file_value": round(sum(single.values()), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
