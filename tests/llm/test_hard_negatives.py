"""Residue products against whole numbers, mined rows against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import hardneg

SCHEMA = "vec_id bigint, embedding array<float>, label int, shard int, score double, positives string"


@pytest.mark.parametrize(("dim", "top"), [(1, 3), (64, 256), (700, 2**12), (2500, 300), (8, 2**29), (64, 2**27)])
def test_residue_products_are_exact(dim, top):
    rng = np.random.default_rng(dim)
    left, right = (rng.integers(-top, top + 1, (n, dim)) for n in (7, 11))
    left[0], right[0] = top, -top
    got = hardneg.whole_products(left.astype(float), right.astype(float))
    assert got.dtype == np.int64
    assert got.tolist() == (left.astype(object) @ right.astype(object).T).tolist()


def test_products_beyond_64_bits_are_refused():
    with pytest.raises(ValueError, match="64-bit"):
        hardneg.whole_products(np.full((1, 4), 2.0**40), np.full((1, 4), 2.0**40))


def test_primes_stay_exact():
    for depth in (1, 2, 64, 1000, 1024):
        found = hardneg.primes(depth)
        assert all(((p - 1) // 2) ** 2 * depth <= hardneg.EXACT and all(p % q for q in range(2, int(p**0.5) + 1)) for p in found)
        assert len(set(found)) == len(found) > 10


def test_firsts_keep_ties_in_order():
    scores = np.array([[5, 7, 7, hardneg.NONE], [hardneg.NONE] * 4, [1, 1, 1, 1]])
    rows, columns = hardneg.firsts(scores, 3)
    assert [columns[rows == k].tolist() for k in range(3)] == [[1, 2, 0], [], [0, 1, 2]]


def held(n: int = 700, dim: int = 10) -> list[tuple]:
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(4, dim))
    labels = np.where(rng.random(n) < 0.35, 0, rng.integers(0, 4, n))
    made = (middle[labels] * 0.7 + rng.normal(size=(n, dim))).astype(np.float32)
    made[200:260] = made[200]
    rows = [(i, [float(x) for x in v], int(g), 0, 0.0, "x") for i, (v, g) in enumerate(zip(made, labels, strict=True))]
    odd = [(2000, None, 1), (2050, [0.0] * dim, 1), (2100, [float("nan")] * dim, 1), (2150, [1.0, None], 1), (2200, [1.0, 2.0], 1), (2250, [2.0, 1.0], 1), (2300, [1.9, 0.1], 2), (None, [1.0] * dim, 1), (2350, [1.0] * dim, None), (2400, [], 1)]
    return [*rows, *((*o, None, None, None) for o in odd), rows[50]]


def brute(rows: list[tuple], every: int) -> list[tuple]:
    good = {i: (np.floor(256 * np.array(v, dtype=float)).astype(np.int64), (g + 1) % 10 if i % 7 == 0 else g) for i, v, g, *_ in rows if i is not None and g is not None and v and None not in v and np.isfinite(v).all()}
    out = []
    for a, (v, g) in good.items():
        if a % every:
            continue
        scores = sorted((-int(v @ w), i, x == g) for i, (w, x) in good.items() if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scores if s[2]][:5]:
            fits = [(s, i) for s, i, same in scores if not same and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, positive, k, i, -p, -s) for k, (s, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [64, 8192])
def test_mined_rows_are_those_of_brute_force(spark, shard):
    rows = held()
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    index = hardneg.labelled(spark.createDataFrame(rows, SCHEMA).repartition(3), moved)
    got = sorted(map(tuple, hardneg.mine(index, index.filter("vec_id % 10 = 0"), shard=shard).collect()))
    assert got == brute(rows, 10) and len(got) > 300


def test_small_and_negative(spark):
    index = hardneg.labelled(spark.createDataFrame(held()[:3], SCHEMA))
    assert hardneg.mine(index.limit(0), index.limit(0)).count() == 0
    turned = [(0, [-0.001, 0.0], 1, None, None, None), (1, [-1e30, 3.0], 1, None, None, None)]
    first = hardneg.labelled(spark.createDataFrame(turned[:1], SCHEMA))
    assert first.first().vec == [-1.0, 0.0] and hardneg.mine(first, first).count() == 0
    assert hardneg.labelled(spark.createDataFrame(turned[1:], SCHEMA)).first().vec[0] < -(2.0**100)
