"""What jobs of many stages leave in the driver."""

from __future__ import annotations

import tracemalloc
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa

from quillgraph.llm import ngramjoin, wordbpe
from quillgraph.llm.common import let_go


def kept_files(spark):
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    return {p.parent.name for p in folder.rglob("part-*")}


def test_checkpoints_go_when_nothing_refers_to_them(spark):
    spark.sparkContext.getCheckpointDir() or spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    before = kept_files(spark)
    rows = spark.range(10).checkpoint()
    made = kept_files(spark) - before
    assert made
    del rows
    for _ in range(20):
        let_go(spark)
        if not made & kept_files(spark):
            break
        spark.range(1).count()
    assert not made & kept_files(spark)


def test_sketch_is_rated_in_blocks(spark):
    rows = [(" ".join(f"w{(i * j) % 97}" for j in range(40)) + " the very same line",) for i in range(200)]
    docs = spark.createDataFrame(rows, "text string")
    counts = np.zeros(ngramjoin.SKETCH)
    made, _ = ngramjoin.ngrams(pa.array([r[0] for r in rows]), 3)
    np.add.at(counts, (made & np.uint64(ngramjoin.SKETCH - 1)).astype(np.int64), 1)
    tracemalloc.start()
    late, parts = ngramjoin.sketch(docs, 3, 8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    above = (counts - counts.mean()) / max(1.0, counts.mean() ** 0.5)
    assert (late == np.where(above >= 4, np.log2(np.maximum(above, 4)) - 1, 0).astype(np.uint8)).all()
    assert (parts == np.ceil(np.log2(np.maximum(1.0, (counts - counts.mean()) / 8))).astype(np.uint8)).all()
    assert late.any() and parts.any()
    # Two bytes a cell, and the counts as they came in.
    assert most < 30 * ngramjoin.SKETCH


def test_driver_keeps_no_tokenizer(spark):
    wordbpe.vocabulary.cache_clear()
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert wordbpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json")).first()["n_tokens"] == 2
    assert wordbpe.vocabulary.cache_info().currsize == 0


def test_no_pairs_look_at_no_texts(spark):
    """Without pairs nothing is laid out: no job but the look for a first pair."""
    pairs = spark.createDataFrame([], "a bigint, b bigint")
    got = ngramjoin._verified(pairs, None, None, 3, 80)
    assert got.columns == ["a", "b"] and got.count() == 0
