"""Manifest and proofs against trees built by hand."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quillgraph.llm import merkle, queries
from quillgraph.plans.tables import table

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree int, leaf string, place int, `group` string"


def h(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    return h("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)


def runs(nodes: list[str]):
    while len(nodes) > 1:
        cut = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        yield cut
        nodes = [h(run) for run in cut]


def proof(nodes: list[str], at: int) -> tuple[list[str], list[int]]:
    path, places = [], []
    for cut in runs(nodes):
        run, j = cut[at // 16], at % 16
        path.append("".join(run[:j] + run[j + 1 :]))
        places.append(j)
        at //= 16
    return path, places


def top(nodes: list[str]) -> str:
    for cut in runs(nodes):
        nodes = [h(run) for run in cut]
    return nodes[0]


def by_hand(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, path, places) of (doc_id, source, lang, n_chars, text)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    held = [[x[2] for x in sorted(groups[s])] for s in order]
    subroots = [top(g) for g in held]
    out = []
    for i, s in enumerate(order):
        for j, (known, doc_id, own) in enumerate(sorted(groups[s])):
            lower, upper = proof(held[i], j), proof(subroots, i)
            out.append((doc_id if known else None, own, subroots[i], top(subroots), lower[0] + upper[0], lower[1] + upper[1]))
    return out


def corpus(n: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot", "hot", None, "é", "z", *(f"s{k}" for k in range(30))])
        rows.append((i * 3, source, rng.choice(["en", None]), i if i % 9 else None, rng.choice(["", None, f"Text {i}", "ß🎉 A" * 50])))
    rows += [(None, "hot", None, None, None), (None, None, None, None, "x"), (5, "hot", "en", 1, "A"), (5, "hot", "en", 1, "B"), (7, "alone", "en", 1, "z")]
    return rows + [rows[0], rows[0], (0, rows[0][1], "de", 2, "w")]


@pytest.mark.parametrize("n", [3, 40, 1400])
def test_proofs_are_those_of_trees_by_hand(spark, n):
    rows = corpus(n) + [(i, "hot", None, None, f"t{i}") for i in range(9 * n, 10 * n)]
    frame = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(4)
    made = merkle.prove(merkle.manifest(frame, queries.LEAF_COLUMNS))
    got = sorted(((r.id, r.leaf, r.subroot, r.root, r.path, r.places) for r in made.collect()), key=str)
    assert got == sorted(by_hand(rows), key=str)


def test_small_and_empty_tables(spark):
    frame = lambda rows: spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)
    empty = merkle.manifest(frame([]), queries.LEAF_COLUMNS)
    assert empty.root is None and merkle.prove(empty).count() == 0
    one = (1, "a", "en", 3, "abc")
    alone = merkle.prove(merkle.manifest(frame([one]), queries.LEAF_COLUMNS)).first()
    assert (alone.leaf, alone.subroot, alone.root, alone.path) == (leaf(one),) * 3 + ([],)


def test_only_tampered_rows_fail(spark):
    got = {r.doc_id: r for r in queries.op12_merkle(spark, "/root/testdata/sf0.001").collect()}
    rows = {r.doc_id: r for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    assert got.keys() == rows.keys()
    for i, r in got.items():
        text = rows[i].text or ""
        changed = zlib.crc32(str(i).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in text)
        assert r.verified == (not changed) and (r.folded_root == r.root) == r.verified


def test_missing_is_the_smallest_union():
    rng = random.Random(8)
    for _ in range(200):
        size = rng.choice([1, 2, 16, 17, 255, 256, 257, 300, 4097, 5000])
        first = rng.randrange(size)
        last = min(size - 1, first + rng.randrange(400))
        leaves = [h([str(k)]) for k in range(size)]
        levels, nodes = [leaves], leaves
        for cut in runs(leaves):
            nodes = [h(run) for run in cut]
            levels.append(nodes)
        above = [{k // 16**level for k in range(first, last + 1)} for level in range(len(levels))]
        needed = {(level, k) for level, own in enumerate(above) for x in own for k in range(x // 16 * 16, min(x // 16 * 16 + 16, len(levels[level]))) if k not in own}
        wants = merkle.missing(first, last, size)
        listed = [(level, k) for level, run, a, b in wants for k in range(run * 16, min(run * 16 + 16, len(levels[level]))) if not a <= k <= b]
        assert len(listed) == len(set(listed)) and set(listed) == needed
        fetched = {(level, run): [levels[level][k] for k in range(run * 16, min(run * 16 + 16, len(levels[level]))) if not a <= k <= b] for level, run, a, b in wants}
        root, steps = merkle.climb(leaves[first : last + 1], first, size, fetched)
        assert root == nodes[0] and len(steps) == len(levels) - 1


def test_folding_follows_a_proof(spark):
    leaves = [h([str(k)]) for k in range(700)]
    rows = [(leaves[k], *proof(leaves, k)) for k in (0, 15, 16, 511, 699)]
    frame = spark.createDataFrame(rows, "leaf string, path array<string>, places array<int>")
    assert {r[0] for r in frame.select(merkle.fold(F.col("leaf"), F.col("path"), F.col("places"))).collect()} == {top(leaves)}
