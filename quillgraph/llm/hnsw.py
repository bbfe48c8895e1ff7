"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

A shard's vectors enter the graph in random order, each linking to diverse
near ones among those before it, on every layer up to its own. The near ones
come from all distances within the shard, computed as one matrix product, so a
build takes the square of a shard, not of the table. Neighbours are kept as flat arrays with offsets. A search descends the layers greedily and
keeps a beam on the lowest; the shards' results are merged.

Equal vectors are one node, so that copies fill no links and no beam. A node
holds the smallest ids of its copies, and a search puts them in its place.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm import vectors as vx
from quillgraph.llm.common import reach_workers
from quillgraph.sources.shared import shared_dir

#: Links of a vector on upper layers (twice as many on the lowest), candidates looked at for them, and the beam of a search.
LINKS, CANDIDATES, BEAM = 16, 64, 128

FOUND = "query_id bigint, vec_id bigint, score double"
INDEX = "dim int, shard int, most int, ids binary, vectors binary, layers binary, offsets binary, neighbours binary, copies binary, ends binary"


@dataclass
class Graph:
    """Layers from the lowest up. Nodes of a layer have positions below ``layers[l]``; offsets of all layers follow each other."""

    ids: np.ndarray
    vectors: np.ndarray
    layers: np.ndarray
    offsets: np.ndarray
    neighbours: np.ndarray

    def links(self, layer: int, node: int) -> np.ndarray:
        at = int((self.layers[:layer] + 1).sum()) + node
        return self.neighbours[self.offsets[at] : self.offsets[at + 1]]

    def search(self, query: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Positions of the nodes that the beam ends with."""
        vectors, base = self.vectors, np.concatenate([[0], np.cumsum(self.layers + 1)])
        at, near = 0, float(((vectors[0] - query) ** 2).sum())
        for layer in range(len(self.layers) - 1, 0, -1):
            while True:
                linked = self.neighbours[self.offsets[base[layer] + at] : self.offsets[base[layer] + at + 1]]
                if not len(linked):
                    break
                gaps = vectors[linked] - query
                gaps = np.einsum("ij,ij->i", gaps, gaps)
                k = int(gaps.argmin())
                if gaps[k] >= near:
                    break
                at, near = int(linked[k]), float(gaps[k])
        seen = np.zeros(len(vectors), dtype=bool)
        seen[at] = True
        open_nodes, kept = [(near, at)], [(-near, at)]
        offsets, neighbours = self.offsets, self.neighbours
        while open_nodes:
            gap, node = heapq.heappop(open_nodes)
            if len(kept) >= beam and gap > -kept[0][0]:
                break
            linked = neighbours[offsets[node] : offsets[node + 1]]
            linked = linked[~seen[linked]]
            if not len(linked):
                continue
            seen[linked] = True
            gaps = vectors[linked] - query
            gaps = np.einsum("ij,ij->i", gaps, gaps)
            for gap, node in zip(gaps.tolist(), linked.tolist(), strict=True):
                if len(kept) < beam:
                    heapq.heappush(kept, (-gap, node))
                elif gap < -kept[0][0]:
                    heapq.heapreplace(kept, (-gap, node))
                else:
                    continue
                heapq.heappush(open_nodes, (gap, node))
        return np.array([node for _, node in kept])


def _diverse(gaps: np.ndarray, order: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Of candidates from near to far, those nearer to the node than to any chosen one, filled up with the nearest others."""
    chosen: list[int] = []
    for c in order.tolist():
        if not chosen or gaps[c] < between[c, chosen].min():
            chosen.append(c)
            if len(chosen) == most:
                return chosen
    others = set(chosen)
    return chosen + [c for c in order.tolist() if c not in others][: most - len(chosen)]


def _layer(vectors: np.ndarray, links: int, most: int) -> list[list[int]]:
    """The links among nodes that enter in the order of the rows."""
    n = len(vectors)
    squares = (vectors**2).sum(axis=1)
    between = np.maximum(squares[:, None] + squares[None, :] - 2 * vectors @ vectors.T, 0)
    linked: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        gaps = between[i, :i]
        near = np.argpartition(gaps, CANDIDATES)[:CANDIDATES] if i > CANDIDATES else np.arange(i)
        near = near[np.argsort(gaps[near], kind="stable")]
        linked[i] = _diverse(gaps, near, between, links)
        for j in linked[i]:
            linked[j].append(i)
    for i in range(n):
        if len(linked[i]) > most:
            own = np.array(linked[i])
            linked[i] = _diverse(between[i], own[np.argsort(between[i, own], kind="stable")], between, most)
    # Pruned links may leave nodes without a way to them: they are linked from the nearest node that has one.
    reached, queue = np.zeros(n, dtype=bool), [0]
    reached[:1] = True
    while True:
        while queue:
            step = [j for j in linked[queue.pop()] if not reached[j]]
            for j in step:
                if not reached[j]:
                    reached[j] = True
                    queue.append(j)
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return linked
        i, there = int(lost[0]), np.flatnonzero(reached)
        linked[int(there[between[i, there].argmin()])].append(i)
        reached[i] = True
        queue.append(i)


def build(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS) -> Graph:
    """The graph of a shard. The order of entry and the layers follow from the ids."""
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x2545F4914F6CDD1D)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(mixed, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # Nodes of upper layers come first, so that a layer is a prefix: a 1/links share on each next layer.
    sizes = [len(ids)]
    while sizes[-1] > links:
        sizes.append(max(1, sizes[-1] // links))
    offsets, neighbours = [], []
    at = 0
    for layer, size in enumerate(sizes):
        linked = _layer(vectors[:size], links, links if layer else 2 * links)
        ends = at + np.cumsum([len(x) for x in linked])
        offsets += [[at], ends]
        at = int(ends[-1]) if size else at
        neighbours += linked
    flat = np.array([j for x in neighbours for j in x], dtype=np.int32)
    return Graph(ids, vectors, np.array(sizes), np.concatenate(offsets).astype(np.int64), flat)


def distinct(vectors: DataFrame, most: int) -> DataFrame:
    """One row ``(vec_id, copies)`` per different vector: its smallest id, and its ``most`` smallest ids in order.

    Vectors are told apart by two 64-bit hashes. A task cuts its rows of a
    vector to ``most`` before they are shuffled.
    """
    hashed = vectors.select("vec_id", F.xxhash64("dim", "vec").alias("one"), F.xxhash64(F.lit(1), "vec").alias("two"))
    by = Window.partitionBy("one", "two").orderBy("vec_id")
    first = hashed.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= most)
    return first.groupBy("one", "two").agg(F.min("vec_id").alias("vec_id"), F.sort_array(F.collect_list("vec_id")).alias("copies")).select("vec_id", "copies")


def index(vectors: DataFrame, shard: int = vx.SHARD, links: int = LINKS, most: int = 11) -> DataFrame:
    """One row per shard of ``vectors (vec_id, vec, dim)``: the graph in flat arrays. Every different vector is in one.

    Of equal vectors the ``most`` smallest ids are kept, which does for
    searches of up to ``most - 1`` vectors.
    """
    spark = vectors.sparkSession
    shared_dir(spark)
    reach_workers(spark)
    known = distinct(vectors, most).checkpoint()
    n_shards = vx.shards(known.count(), shard)

    def make(rows: pa.Table) -> pa.Table:
        graph = build(*vx.matrix(rows), links)
        copies = dict(zip(rows["vec_id"].to_pylist(), rows["copies"].to_pylist(), strict=True))
        copies = [copies[i] for i in graph.ids.tolist()]
        held = {"ids": graph.ids, "vectors": graph.vectors, "layers": graph.layers, "offsets": graph.offsets, "neighbours": graph.neighbours}
        held |= {"copies": np.array([i for x in copies for i in x]), "ends": np.cumsum([0] + [len(x) for x in copies])}
        kinds = {"ids": "<i8", "vectors": "<f8", "layers": "<i8", "offsets": "<i8", "neighbours": "<i4", "copies": "<i8", "ends": "<i8"}
        columns = {c: pa.array([x], pa.int32()) for c, x in (("dim", rows["dim"][0].as_py()), ("shard", rows["shard"][0].as_py()), ("most", most))}
        return pa.table(columns | {c: pa.array([x.astype(kinds[c]).tobytes()], pa.binary()) for c, x in held.items()})

    nodes = vectors.join(known, "vec_id")
    return nodes.withColumn("shard", vx.placed(nodes, n_shards)).groupBy("dim", "shard").applyInArrow(make, INDEX)


def search(graphs: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM, block: int = vx.BLOCK) -> DataFrame:
    """The ``k`` nearest found for every query by Euclidean distance: ``(query_id, rank, vec_id, score)``.

    A query's own id is no candidate; vectors of another length are none.
    Distances are computed in double precision; ties go to the smaller id. All
    candidates come back where there are at most ``k``; empty tables give no
    rows. Each task searches one shard for one block of queries. All copies of
    a vector that is found are candidates, so ties among copies are exact.
    """
    reach_workers(graphs.sparkSession)
    last, most = graphs.agg(F.max("shard"), F.min("most")).first()
    n_shards = (last or 0) + 1
    if most is not None and k >= most:
        raise ValueError(f"the index keeps {most} ids of equal vectors: no search for more than {most - 1}")
    n_blocks = vx.shards(queries.count(), block)
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = vx.to_all(queries, n_shards, n_blocks)

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            row = {c: left[c][0].as_py() for c in ("ids", "vectors", "layers", "offsets", "neighbours", "copies", "ends")}
            ids, copies, ends = (np.frombuffer(row[c], "<i8") for c in ("ids", "copies", "ends"))
            graph = Graph(
                ids, np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1), np.frombuffer(row["layers"], "<i8"),
                np.frombuffer(row["offsets"], "<i8"), np.frombuffer(row["neighbours"], "<i4"),
            )
            for query_id, query in zip(*vx.matrix(right), strict=True):
                near = graph.search(query, max(beam, k + 1)) if len(ids) > k + 1 else np.arange(len(ids))
                gaps = np.sqrt(((graph.vectors[near] - query) ** 2).sum(axis=1))
                # One of these may be the query alone, so one more is needed.
                first = np.lexsort((ids[near], gaps))[: k + 1]
                found = np.concatenate([copies[ends[i] : ends[i + 1]] for i in near[first].tolist()])
                gaps = np.repeat(gaps[first], ends[near[first] + 1] - ends[near[first]])
                found, gaps = found[found != query_id], gaps[found != query_id]
                order = np.lexsort((found, gaps))[:k]
                out[0].extend([int(query_id)] * len(order))
                out[1].extend(found[order].tolist())
                out[2].extend(gaps[order].tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    keys = ["dim", "shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(find, FOUND)
    return vx.best(found, k, F.col("score"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, **options) -> DataFrame:
    """Index ``vectors``, keep the graphs in the shared folder, and search them."""
    shared_dir(vectors.sparkSession)
    return search(index(vectors, most=k + 1).checkpoint(), queries, k, **options)
