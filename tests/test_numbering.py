from __future__ import annotations

import random

import pytest

import quillgraph as qg


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_running_total_and_numbers(spark, size):
    rng = random.Random(4)
    held = [(rng.choice("abc"), i, rng.randint(0, 9)) for i in range(size)]
    rows = spark.createDataFrame(held, "file string, block bigint, n bigint").repartition(5)
    expected, before = {}, 0
    for place, (file, block, n) in enumerate(sorted(held)):
        expected[file, block] = (place, before)
        before += n
    totals = {(r.file, r.block): r.before for r in qg.running_total(rows, "n", "file", "block").collect()}
    assert totals == {key: total for key, (_, total) in expected.items()}
    numbers = {(r.file, r.block): r.row for r in qg.numbered(rows, "file", "block").collect()}
    assert numbers == {key: place for key, (place, _) in expected.items()}


def test_no_window_without_a_key(spark):
    rows = spark.range(100).selectExpr("id % 7 as file", "id as block", "1 as n")
    for made in (qg.running_total(rows, "n", "file", "block"), qg.numbered(rows, "file", "block")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
        assert "NestedLoop" not in plan and "Cartesian" not in plan
