from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import hnsw


def test_groups_of_copies_larger_than_the_beam(spark):
    rng = np.random.default_rng(7)
    made = rng.normal(size=(1200, 8))
    made[rng.permutation(1200)[:400]] = made[5]
    made[rng.permutation(1200)[:200]] = made[6] + 0.0
    rows = spark.createDataFrame([(i, [float(x) for x in v], 8) for i, v in enumerate(made)], "vec_id bigint, vec array<double>, dim int").repartition(5)
    got = hnsw.nearest(rows, rows.filter("vec_id % 5 = 0"), k=10).collect()
    hits = 0
    for q in range(0, 1200, 5):
        gaps = np.sqrt(((made - made[q]) ** 2).sum(axis=1))
        expected = [i for i in np.lexsort((np.arange(1200), gaps)).tolist() if i != q][:10]
        own = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert len(own) == 10
        if gaps[expected[9]] == 0:
            assert own == expected
        hits += len(set(own) & set(expected))
    assert hits >= 0.95 * 10 * 240


def test_only_copies(spark):
    rows = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("vec"), F.lit(2).alias("dim"))
    got = sorted(tuple(r) for r in hnsw.nearest(rows, rows.filter("vec_id in (3, 250)"), k=4).collect())
    assert got == [(3, r, i, 0.0) for r, i in enumerate((0, 1, 2, 4), 1)] + [(250, r, i, 0.0) for r, i in enumerate(range(4), 1)]
    with pytest.raises(ValueError, match="equal vectors"):
        hnsw.search(hnsw.index(rows, most=4), rows, k=4)
