"""Hard-negative mining on exact scores from a residue number system.

Whole-number vectors are reduced modulo several small primes; each residue
matrix product runs in float32, where its sums are exact, and Chinese
remaindering puts the signed scores together again. An anchor's positives are
its best rows of the same label, its negatives for a positive the best rows of
other labels within a band below the positive's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm import vectors as vx
from quillgraph.llm.common import reach_workers

#: Rows of a shard, and of a strip of it; anchors that a task multiplies at once.
SHARD, STRIP, ANCHORS = 8192, 4096, 256
#: Float32 adds whole numbers exactly up to this size.
EXACT = 2**24
#: Components that one product adds up; longer vectors are cut.
DEPTH = 1024
#: A score that is not there.
NONE = np.iinfo(np.int64).min

LISTED = "array<struct<vec_id:bigint,score:bigint>>"
FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"


def labelled(vectors: DataFrame, label: Column | None = None, scale: int = 256) -> DataFrame:
    """The rows that take part: ``(vec_id, label, vec, dim)``, components floor(scale * x).

    Null ids, labels and vectors, empty vectors and those with a null or
    non-finite component are left out. Of several rows with one id the
    smallest (vector, label) counts. ``label`` replaces the column's value.
    """
    x = F.col("vec")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), (F.col("label") if label is None else label).cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad)
    best = rows.groupBy("vec_id").agg(F.min(F.struct("vec", "label")).alias("row"))
    # A double of 2**53 or more is whole, and may be more than a bigint holds.
    scaled = F.transform("row.vec", lambda e: F.when(F.abs(e * scale) < 2.0**53, F.floor(e * scale).cast("double")).otherwise(e * scale))
    return best.select("vec_id", F.col("row.label").alias("label"), scaled.alias("vec"), F.size("row.vec").alias("dim"))


@lru_cache(maxsize=8)
def primes(depth: int) -> tuple[int, ...]:
    """Primes, largest first, whose balanced residues multiply and add up exactly over ``depth`` components."""
    half = int((EXACT / depth) ** 0.5)
    sieve = np.ones(2 * half + 2, dtype=bool)
    sieve[:2] = False
    for k in range(2, int(len(sieve) ** 0.5) + 1):
        sieve[k * k :: k] &= not sieve[k]
    odd = np.flatnonzero(sieve)
    return tuple(int(p) for p in odd[(odd > 2) & ((odd - 1) // 2 <= half)][::-1])


def chosen(depth: int, bound: float) -> list[int]:
    """As many of these primes as tell apart all whole numbers from ``-bound`` to ``bound``."""
    picked, product = [], 1
    for p in primes(depth):
        if product > 2 * bound:
            break
        picked.append(p)
        product *= p
    if product <= 2 * bound:
        raise ValueError(f"scores up to {bound:g} are beyond the residue number system over {depth} components")
    return picked


def residues(rows: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of whole numbers, which a double holds exactly."""
    low = np.fmod(rows, p)
    return (low - p * np.rint(low / p)).astype(np.float32)


def whole_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The exact products of all rows of ``left`` with all of ``right``, as 64-bit integers.

    Both hold whole numbers as doubles. Products must fit 64 bits.
    """
    if not len(left) or not len(right):
        return np.zeros((len(left), len(right)), dtype=np.int64)
    dim = left.shape[1]
    depth = min(dim, DEPTH)
    # By Cauchy and Schwarz; the little more is for the rounding of the norms.
    bound = float(np.sqrt((left**2).sum(axis=1).max()) * np.sqrt((right**2).sum(axis=1).max())) * (1 + 1e-9) + 1
    if not bound < 2.0**63:
        raise ValueError("scores must fit a 64-bit integer")
    picked = chosen(depth, bound)
    product = 1
    kind = np.int64
    for p in picked:
        product *= p
    if product * max(picked) >= 2**63:
        kind = object
    total, base = np.zeros((len(left), len(right)), dtype=kind), 1
    for p in picked:
        mine, other = residues(left, p), residues(right, p)
        rest = np.zeros(total.shape, dtype=np.int64)
        for start in range(0, dim, depth):
            rest += (mine[:, start : start + depth] @ other[:, start : start + depth].T).astype(np.int64)
        # Garner: the next digit in the mixed radix of the primes so far.
        digit = (rest - (total % p).astype(np.int64)) % p * pow(base, -1, p) % p
        total = total + digit.astype(kind) * base
        base *= p
    return np.where(total > base // 2, total - base, total).astype(np.int64)


def firsts(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the ``k`` largest values that are there, equal ones from left to right: row and column positions.

    ``scores`` is written over.
    """
    if not scores.size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    every, rows, columns = np.arange(len(scores)), [], []
    for _ in range(k):
        at = scores.argmax(axis=1)
        there = scores[every, at] != NONE
        if not there.any():
            break
        rows.append(every[there])
        columns.append(at[there])
        scores[every, at] = NONE
    return (np.concatenate(rows), np.concatenate(columns)) if rows else (np.zeros(0, dtype=np.int64),) * 2


class Shard:
    """The rows of a shard in the order of their ids."""

    def __init__(self, rows: pa.Table) -> None:
        self.ids, self.vecs = vx.matrix(rows)
        labels = rows.column("label").to_numpy()
        self.labels = labels[np.argsort(rows.column("vec_id").to_numpy(), kind="stable")]

    def strips(self) -> Iterator[slice]:
        for start in range(0, len(self.ids), STRIP):
            yield slice(start, start + STRIP)

    def positives(self, asked: pa.Table, k: int) -> Iterator[dict[str, np.ndarray]]:
        """The ``k`` best rows of the anchors' own label in each strip."""
        ids, vecs = vx.matrix(asked)
        labels = asked.column("label").to_numpy()[np.argsort(asked.column("vec_id").to_numpy(), kind="stable")]
        for label in np.unique(labels):
            who = np.flatnonzero(labels == label)
            for part in self.strips():
                same = np.flatnonzero(self.labels[part] == label) + part.start
                scores = whole_products(vecs[who], self.vecs[same])
                values = scores.copy()
                values[ids[who][:, None] == self.ids[same][None, :]] = NONE
                row, column = firsts(values, k)
                yield {"anchor_id": ids[who[row]], "positive_id": None, "positive_score": None, "vec_id": self.ids[same[column]], "score": scores[row, column]}

    def negatives(self, asked: pa.Table, k: int, low: int, high: int) -> Iterator[dict[str, np.ndarray]]:
        """For each anchor and positive the ``k`` best rows of other labels in the band, of each strip."""
        ids, vecs = vx.matrix(asked)
        order = np.argsort(asked.column("vec_id").to_numpy(), kind="stable")
        labels = asked.column("label").to_numpy()[order]
        given = [asked.column("positives")[int(i)].as_py() or [] for i in order]
        most = max(map(len, given), default=0)
        for part in self.strips():
            scores = whole_products(vecs, self.vecs[part])
            other = self.labels[part][None, :] != labels[:, None]
            for j in range(most):
                who = np.array([i for i, g in enumerate(given) if len(g) > j], dtype=np.int64)
                positive = [given[i][j] for i in who]
                # Whole numbers of any size: the band's ends as whole scores.
                floor = np.array([-(-low * p["score"] // 100) for p in positive], dtype=np.int64)
                ceiling = np.array([high * p["score"] // 100 for p in positive], dtype=np.int64)
                some = scores[who]
                fits = other[who] & (some >= floor[:, None]) & (some <= ceiling[:, None])
                row, column = firsts(np.where(fits, some, NONE), k)
                names = np.array([p["vec_id"] for p in positive], dtype=np.int64)
                values = np.array([p["score"] for p in positive], dtype=np.int64)
                yield {"anchor_id": ids[who[row]], "positive_id": names[row], "positive_score": values[row], "vec_id": self.ids[part][column], "score": some[row, column]}


def _searched(rows: DataFrame, anchors: DataFrame, n_shards: int, ask) -> DataFrame:
    """Each anchor meets each shard; ``ask(shard, anchors)`` yields columns of FOUND.

    A shard's rows come first in their partition, its anchors after them, so a
    task holds one shard and ``ANCHORS`` anchors at a time, however many there
    are. The rows of the index are shuffled once.
    """
    none = F.lit(None).cast(LISTED)
    held = rows.select(vx.placed(rows, n_shards).alias("shard"), "dim", F.lit(0).alias("kind"), "vec_id", "label", "vec", none.alias("positives"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    asking = anchors.select(every.alias("shard"), "dim", F.lit(1).alias("kind"), "vec_id", "label", "vec", "positives")
    dealt = held.unionByName(asking).repartition(max(n_shards, 1), "shard", "dim").sortWithinPartitions("shard", "dim", "kind", "vec_id")
    schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")])

    def answers(shard: Shard, waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting)
        for start in range(0, table.num_rows, ANCHORS):
            for found in ask(shard, table.slice(start, ANCHORS)):
                n = len(found["anchor_id"])
                if n:
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if found[f] is None else pa.array(found[f], pa.int64()) for f in schema.names], schema=schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "dim", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                place, kind = tuple(keys[start, :2]), keys[start, 2]
                if place != at:
                    at, index, shard = place, [], None
                part = batch.slice(start, stop - start)
                if kind == 0:
                    index.append(part)
                elif index:
                    if shard is None:
                        shard = Shard(pa.Table.from_batches(index))
                    yield from answers(shard, [part])

    return dealt.mapInArrow(search, FOUND)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, shard: int = SHARD) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` and ``anchors`` are ``(vec_id, label, vec, dim)`` from
    :func:`labelled`. A positive is one of the first ``positives`` other rows
    of the anchor's label, by score, ties to the smaller id; for each of them
    the first ``negatives`` rows of other labels with ``low * positive <= 100 *
    negative <= high * positive`` are returned. All that there are come back
    where there are fewer; only vectors as long as the anchor are compared. An
    anchor without positives, a positive without negatives and empty tables
    give no rows; equal vectors under several ids are several rows. Scores
    beyond 64 bits raise an error.

    The index goes to shards by hash of the id, so no label is hot. Each shard
    returns at most the rows wanted of each strip, and a window picks among
    them. Both passes read every score once: the first those of the anchor's
    own label, the second all.
    """
    reach_workers(rows.sparkSession)
    n_shards = vx.shards(rows.count(), shard)
    plain = anchors.withColumn("positives", F.lit(None).cast(LISTED))
    near = _searched(rows, plain, n_shards, lambda s, asked: s.positives(asked, positives))
    by = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= positives)
    listed = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score")))
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.transform(listed, lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("positives"))
    far = _searched(rows, anchors.join(near, "vec_id"), n_shards, lambda s, asked: s.negatives(asked, negatives, low, high))
    by = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
