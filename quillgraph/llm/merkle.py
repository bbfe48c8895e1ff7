"""Merkle manifest of a dataset, with the proofs of all leaves.

Rows are hashed to leaves, leaves of a group are gathered in runs of sixteen
up to one subroot, and the subroots in the same way up to the root. Leaves
live in blocks of neighbours. To prove its leaves a block computes the union
of the nodes that it lacks (the octopus: beside its own path at most fifteen a
level), fetches each once, derives the interior nodes that its leaves share
and writes out the proof of each leaf from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import reach_workers
from quillgraph.operators.numbering import numbered
from quillgraph.operators.skew import salted_join
from quillgraph.sources.shared import shared_dir

#: Nodes of a run, and characters of a digest.
ARITY, DIGITS = 16, 64
#: A block holds the leaves below one node of this level, so ARITY**BLOCK_LEVEL at most.
BLOCK_LEVEL = 2
SPAN = ARITY**BLOCK_LEVEL
#: The tree over the subroots; the trees of groups are numbered from 0.
TOP = -1

LEAF = "leaf string, claimed string"
PROOF = "subroot string, path array<string>, places array<int>"
WANTS = "array<struct<tree:bigint,level:int,run:bigint,first:bigint,last:bigint>>"


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def fold(start: Column, path: Column, places: Column) -> Column:
    """The root that a leaf and its proof lead to: ``path`` holds the siblings of each level, ``places`` where the node stands."""

    def up(node: Column, level: Column) -> Column:
        before = DIGITS * level["places"]
        run = F.concat(F.substring(level["path"], F.lit(1), before), node, F.substring(level["path"], before + 1, F.length(level["path"])))
        return F.sha2(run.cast("binary"), 256)

    return F.aggregate(F.arrays_zip(path.alias("path"), places.alias("places")), start, up)


@dataclass
class Manifest:
    """``leaves``: (id, leaf, claimed, tree, place, size, block); ``runs``: (tree, level, run, hashes) above the blocks."""

    leaves: DataFrame
    blocks: DataFrame
    runs: DataFrame
    trees: int
    root: str | None


def manifest(rows: DataFrame, columns: Sequence[str], group: str = "source", order: str = "doc_id", claimed: Column | None = None) -> Manifest:
    """Hash rows to leaves and build all trees.

    A leaf is the digest of ``columns``, nulls included; ``claimed`` is what
    somebody says it is, the leaf itself by default. Groups are ordered by
    their bytes, a null group first; leaves of a group by ``order``, nulls
    first, then by their digest, so that equal rows are different leaves and
    rows of one id have a fixed order. An empty table has no root.

    Leaves are frozen by a checkpoint, numbered by ranges of their order (a
    hot group is cut through) and dealt out by block. Each further level has a
    sixteenth of the rows of the one before.
    """
    spark = rows.sparkSession
    reach_workers(spark)
    shared_dir(spark)
    own = leaf([F.col(c) for c in columns])
    hashed = rows.select(
        F.col(order).alias("id"), F.col(group).alias("group"), own.alias("leaf"), (own if claimed is None else claimed).alias("claimed"), F.monotonically_increasing_id().alias("tie")
    ).checkpoint()
    ordered = numbered(hashed, F.asc_nulls_first("group"), F.asc_nulls_first("id"), "leaf", "tie").drop("tie")
    ordered = ordered.withColumn("key", field(F.col("group")))

    groups = ordered.groupBy("key").agg(F.min("row").alias("start"), F.count("*").alias("size")).checkpoint()
    trees = groups.count()
    groups = numbered(groups, "start", name="tree")
    leaves = salted_join(ordered, groups, "key", "row", "size").withColumn("place", F.col("row") - F.col("start"))
    leaves = leaves.withColumn("block", F.expr(f"place div {SPAN}")).select("id", "leaf", "claimed", "tree", "place", "size", "block")
    leaves = leaves.checkpoint()

    schema = f"tree bigint, block bigint, size bigint, level int, hash string, wants {WANTS}"
    blocks = leaves.select("tree", "block", "size", "place", "leaf").groupBy("tree", "block").applyInArrow(_block_node(trees), schema).checkpoint()
    nodes = blocks.select("tree", F.col("block").alias("place"), "size", "hash")
    runs, subroots = _climb(nodes, BLOCK_LEVEL)
    top = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(trees).cast("bigint").alias("size"), "hash")
    top_runs, roots = _climb(top, 0)
    found = roots.first()
    return Manifest(leaves, blocks, runs.unionByName(top_runs), trees, None if found is None else found["hash"])


def _climb(nodes: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """All runs from ``level`` up, and the last node of each tree as ``(tree, hash)``.

    ``size`` is the number of leaves of the tree: one node is left at the
    first level where ``ARITY**level`` reaches it.
    """
    ends = nodes.filter(F.col("size") <= ARITY**level).select("tree", "hash")
    nodes = nodes.filter(F.col("size") > ARITY**level)
    runs = nodes.select("tree", F.lit(level).alias("level"), F.col("place").alias("run"), F.array("hash").alias("hashes")).limit(0)
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > ARITY**level:
        listed = F.array_sort(F.collect_list(F.struct("place", "hash")))
        run = nodes.groupBy("tree", F.expr(f"place div {ARITY}").alias("run"), "size").agg(listed["hash"].alias("hashes")).checkpoint()
        runs = runs.unionByName(run.select("tree", F.lit(level).alias("level"), "run", "hashes"))
        level += 1
        nodes = run.select("tree", F.col("run").alias("place"), "size", F.sha2(F.concat_ws("", "hashes").cast("binary"), 256).alias("hash"))
        ends = ends.unionByName(nodes.filter(F.col("size") <= ARITY**level).select("tree", "hash"))
        nodes = nodes.filter(F.col("size") > ARITY**level)
    return runs, ends


def digest(run: Sequence[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def missing(first: int, last: int, size: int) -> list[tuple[int, int, int, int]]:
    """What leaves ``first`` to ``last`` of a tree lack for their proofs: ``(level, run, own first, own last)``.

    At each level their own nodes are neighbours, so only the first and the
    last run can hold others; from those all but the own nodes are wanted.
    """
    wants, level = [], 0
    while size > 1:
        for run in sorted({first // ARITY, last // ARITY}):
            start, stop = run * ARITY, min(run * ARITY + ARITY, size) - 1
            if first > start or last < stop:
                wants.append((level, run, max(first, start), min(last, stop)))
        first, last, size, level = first // ARITY, last // ARITY, -(-size // ARITY), level + 1
    return wants


def climb(held: Sequence[str], first: int, size: int, fetched: dict[tuple[int, int], list[str]]) -> tuple[str, list[tuple[list[str], list[int]]]]:
    """The root over neighbouring leaves, and for each level the siblings and the place of each own node.

    ``fetched`` gives by ``(level, run)`` the nodes of that run that are not
    above the leaves held.
    """
    levels, level = [], 0
    while size > 1:
        paths, places, above, last = [], [], [], first + len(held) - 1
        for run in range(first // ARITY, last // ARITY + 1):
            a, b = max(first, run * ARITY), min(last, run * ARITY + ARITY - 1)
            others = fetched.get((level, run), [])
            start = a - run * ARITY
            nodes = [*others[:start], *held[a - first : b - first + 1], *others[start:]]
            whole = "".join(nodes)
            for j in range(start, start + b - a + 1):
                paths.append(whole[: DIGITS * j] + whole[DIGITS * j + DIGITS :])
                places.append(j)
            above.append(digest(nodes))
        levels.append((paths, places))
        held, first, size, level = above, first // ARITY, -(-size // ARITY), level + 1
    return held[0], levels


def _block_node(trees: int):
    """The node over a block, and what the block lacks in its own tree and the one above."""

    def node(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        tree, block = (x.as_py() for x in key)
        rows = rows.sort_by("place")
        held, size = rows.column("leaf").to_pylist(), rows.column("size")[0].as_py()
        first, level, left = block * SPAN, 0, size
        wants = [(tree, *w) for w in missing(first, first + len(held) - 1, size)] + [(TOP, *w) for w in missing(tree, tree, trees)]
        while left > 1 and level < BLOCK_LEVEL:
            held = [digest(held[k : k + ARITY]) for k in range(0, len(held), ARITY)]
            level, left = level + 1, -(-left // ARITY)
        names = ("tree", "level", "run", "first", "last")
        kind = pa.list_(pa.struct([("tree", pa.int64()), ("level", pa.int32()), ("run", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
        listed = pa.array([[dict(zip(names, w, strict=True)) for w in wants]], kind)
        whole = [pa.array([x], pa.int64()) for x in (tree, block, size)]
        return pa.table([*whole, pa.array([level], pa.int32()), pa.array([held[0]], pa.string()), listed], ["tree", "block", "size", "level", "hash", "wants"])

    return node


def fetch(made: Manifest) -> DataFrame:
    """The nodes each block lacks: ``(tree, block, of, level, run, hashes)``, no node twice.

    Runs near a root are wanted by all blocks below it; such a run is repeated
    over parts of its requests.
    """
    node = F.concat_ws(":", F.col("w.tree").cast("string"), F.col("w.level").cast("string"), F.col("w.run").cast("string"))
    wants = made.blocks.select("tree", "block", F.explode("wants").alias("w")).withColumn("node", node)
    asked = wants.groupBy("node").agg(F.count("*").alias("times"))
    name = F.concat_ws(":", F.col("tree").cast("string"), F.col("level").cast("string"), F.col("run").cast("string"))
    runs = made.runs.select(name.alias("node"), "hashes").join(asked, "node")
    met = salted_join(wants, runs, "node", "block", "times")
    start = F.col("w.run") * ARITY
    others = F.filter("hashes", lambda _, i: (start + i < F.col("w.first")) | (start + i > F.col("w.last")))
    return met.select("tree", "block", F.col("w.tree").alias("of"), F.col("w.level").alias("level"), F.col("w.run").alias("run"), others.alias("hashes"))


def prove(made: Manifest) -> DataFrame:
    """The proof of every leaf: ``(id, leaf, claimed, subroot, root, path, places)``.

    ``path`` holds for each level up to the root, that of the subroots
    included, the digests of the run's other nodes from left to right;
    ``places`` tells where the node itself stands among them. A group of one
    leaf starts at the level of the subroots, one leaf alone has no levels.
    """
    trees = made.trees
    kind = made.leaves.schema["id"].dataType.simpleString()

    def expand(key: tuple[pa.Scalar, ...], rows: pa.Table, nodes: pa.Table) -> pa.Table:
        tree, block = (x.as_py() for x in key)
        rows = rows.sort_by("place")
        got: dict[int, dict[tuple[int, int], list[str]]] = {tree: {}, TOP: {}}
        for n in nodes.to_pylist():
            got[n["of"]][n["level"], n["run"]] = n["hashes"]
        first, size = block * SPAN, rows.column("size")[0].as_py()
        subroot, levels = climb(rows.column("leaf").to_pylist(), first, size, got[tree])
        _, above = climb([subroot], tree, trees, got[TOP])
        paths, places = [], []
        for k in range(rows.num_rows):
            at = [((first + k) // ARITY**i - first // ARITY**i) for i in range(len(levels))] + [0] * len(above)
            paths.append([p[j] for (p, _), j in zip([*levels, *above], at, strict=True)])
            places.append([x[j] for (_, x), j in zip([*levels, *above], at, strict=True)])
        proofs = [pa.array([subroot] * rows.num_rows, pa.string()), pa.array(paths, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))]
        return pa.table([*(rows.column(c) for c in ("id", "leaf", "claimed")), *proofs], ["id", "leaf", "claimed", "subroot", "path", "places"])

    keys = ["tree", "block"]
    proved = made.leaves.groupBy(*keys).cogroup(fetch(made).groupBy(*keys)).applyInArrow(expand, f"id {kind}, {LEAF}, {PROOF}")
    return proved.select("id", "leaf", "claimed", "subroot", F.lit(made.root).cast("string").alias("root"), "path", "places")
