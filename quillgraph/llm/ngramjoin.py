"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, sorted-array intersection.

A document is the set of hashes of its word n-grams; documents of one set are
one class. Two sets that are similar enough share one of their first n-grams
in any common order. The order puts n-grams that are frequent in the corpus
last, so that a line in a third of all documents brings nothing together.

1. The class that has an n-gram earliest in its order is the n-gram's hub.
   Every class is held against the hub it meets most often, which joins groups
   of near copies by one pair a class, then against its other hubs that are in
   other components.
2. Where other classes at an n-gram are still in different components, they
   meet in tiles of neighbouring size bands, so that no link is lost.

A pair is looked at only at n-grams whose places in both sets leave room for
enough overlap behind them, as the first n-gram that linked sets share always
does. Then the hashed bitmaps of the pair bound its overlap from above before
the sorted arrays are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import let_go, reach_workers, slices
from quillgraph.llm.components import components
from quillgraph.llm.rolling import Ranges, buffer, mix
from quillgraph.sources.shared import shared_dir

#: Cells of the sketch of n-gram frequencies and of a block of it; its size does not grow with the corpus.
SKETCH, CELLS = 1 << 20, 1 << 12
#: Bytes of text that are cut into n-grams at once.
PART = 1 << 20
#: Classes that are asked for by broadcast, a few numbers each; beyond that texts are shuffled to them.
ASKED = 500_000
#: Rows of an n-gram, by the sketch, that stay together.
TOGETHER = 250_000
#: Rows of a tile that one task holds, and that are compared at once with those before them.
TILE, ROWS = 4096, 64
#: Members of a hub that are intersected in one group.
SPREAD = 512

_BASE = 0xD6E8FEB86659FD93
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def ngrams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams of the texts, and where each text's begin, with the end of the last.

    Words are runs of characters other than ASCII white space, A-Z in lower
    case. A text with fewer than ``n`` words has its whole sequence as one, a
    text without words has none.
    """
    raw, ends = buffer(texts)
    blank = np.ones(len(raw) + 2, dtype=bool)
    blank[1:-1] = _SPACES[raw]
    inside = ~blank
    # A text's end ends a word too.
    first = inside[1:-1] & blank[:-2]
    heads = ends[:-1][ends[:-1] < ends[1:]]
    first[heads] = inside[1:-1][heads]
    starts = np.flatnonzero(first)
    last = inside[1:-1] & blank[2:]
    last[ends[1:][ends[1:] > ends[:-1]] - 1] = inside[1:-1][ends[1:][ends[1:] > ends[:-1]] - 1]
    stops = np.flatnonzero(last) + 1
    words = Ranges(_LOWER[raw], _BASE).of(starts, stops)
    cuts = np.searchsorted(starts, ends)
    counts = np.diff(cuts)
    sizes = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(cuts[:-1] - begins[:-1], sizes) + np.arange(begins[-1])
    stop = np.repeat(cuts[1:], sizes)
    made = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            there = at + k < stop
            made[there] = mix(made[there] * np.uint64(0x9FB21C651E98DF25) + words[at[there] + k] + np.uint64(k + 1))
    return made, begins


def sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`ngrams`, each text's hashes distinct and ascending."""
    made, begins = ngrams(texts, n)
    for a, b in zip(begins.tolist(), begins[1:].tolist(), strict=False):
        made[a:b].sort()
    new = np.ones(len(made), dtype=bool)
    new[1:] = made[1:] != made[:-1]
    new[begins[:-1][np.diff(begins) > 0]] = True
    return made[new], np.concatenate([[0], np.cumsum(new)])[begins]


def sketch(docs: DataFrame, n: int, together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray]:
    """How frequent n-grams are, by the cell of their hash: 0 for most, more the further a cell is above the mean.

    And in how many parts, as a power of two, the rows of such an n-gram are
    to be dealt out. Neither changes a result. Tasks send their counts in
    blocks, which are added up and rated block by block.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.uint32)
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                made, _ = ngrams(batch.column("text").slice(start, stop - start), n)
                total += np.bincount((made & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        if total.any():
            yield _blocks({i: total[i * CELLS : (i + 1) * CELLS] for i in range(SKETCH // CELLS)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, dtype="<u8" if len(counts) == 8 * CELLS else "<u4").astype(np.uint64)
        if sums:
            yield _blocks(sums)

    schema = "block int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    blocks = {row["block"]: np.frombuffer(row["counts"], dtype="<u8") for row in rows}
    mean = sum(int(counts.sum()) for counts in blocks.values()) / SKETCH
    late, parts = np.zeros(SKETCH, dtype=np.uint8), np.zeros(SKETCH, dtype=np.uint8)
    for block, counts in blocks.items():
        at, above = slice(block * CELLS, (block + 1) * CELLS), counts - mean
        deviations = above / max(1.0, mean**0.5)
        late[at] = np.where(deviations >= 4, np.log2(np.maximum(deviations, 4)) - 1, 0)
        parts[at] = np.ceil(np.log2(np.maximum(1.0, above / together)))
    return late, parts


def _blocks(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    bodies = pa.array([x.tobytes() for x in counts.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), bodies], ["block", "counts"])


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit for each hash, in about as many places as there are hashes, a power of two."""
    places = 64
    while places < len(hashes):
        places *= 2
    bits = np.zeros(places, dtype=np.uint8)
    bits[((hashes >> np.uint64(20)) % np.uint64(places)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int) -> bool:
    """Whether bit counts allow an overlap of ``percent`` of the union.

    A place set for one side only stands for at least one hash of that side
    only, so the overlap is at most its size less those places.
    """
    if n_a > n_b:
        n_a, bits_a, n_b, bits_b = n_b, bits_b, n_a, bits_a
    if 100 * n_a < percent * n_b:
        return False
    a, b = int.from_bytes(bits_a, "little"), int.from_bytes(bits_b, "little")
    size = len(bits_b)
    while size > len(bits_a):
        size //= 2
        b = (b | b >> (8 * size)) & ((1 << (8 * size)) - 1)
    both = min(n_a - (a & ~b).bit_count(), n_b - (b & ~a).bit_count())
    return 100 * both >= percent * (n_a + n_b - both)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: whether the overlap of two sorted arrays is ``percent`` of their union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def classes(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, key, n, cls, bits)`` of every row: set size, the set's hash and its bitmap; null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                part = batch.slice(start, stop - start)
                made, begins = sets(part.column("text"), n)
                size = np.diff(begins)
                name, bits = class_names(made, begins), []
                for a, b in zip(begins.tolist(), begins[1:].tolist(), strict=False):
                    bits.append(bitmap(made[a:b]) if b > a else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(size, pa.int64()), pa.array(name, pa.int64(), mask=size == 0), pa.array(bits, pa.binary())],
                    ["doc_id", "key", "n", "cls", "bits"],
                )

    return docs.select("doc_id", "key", "text").mapInArrow(make, f"doc_id {kind}, key bigint, n bigint, cls bigint, bits binary")


def class_names(made: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    sums = np.zeros(len(made) + 1, dtype=np.uint64)
    np.cumsum(mix(made ^ np.uint64(_BASE)), out=sums[1:])
    with np.errstate(over="ignore"):
        return mix(sums[begins[1:]] - sums[begins[:-1]] + np.diff(begins).astype(np.uint64)).view(np.int64)


def first_grams(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, parts: np.ndarray) -> DataFrame:
    """``(gram, part, cls, place)``: the first n-grams of each set, of which similar sets share one.

    ``place`` is the n-gram's position in the common order, with the set's size
    in the lower 32 bits. ``part`` is 0 but for n-grams that are dealt out:
    then it is one of theirs, counted from 1.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                made, begins = sets(batch.column("text").slice(start, stop - start), n)
                name, sizes = class_names(made, begins), np.diff(begins)
                # a class has its n-grams once in a part
                _, once = np.unique(name, return_index=True)
                grams, owners, places = [], [], []
                for i in once.tolist():
                    size = int(sizes[i])
                    if size:
                        own = made[begins[i] : begins[i + 1]]
                        late = frequent[(own & np.uint64(SKETCH - 1)).astype(np.int64)]
                        count = size - (percent * size + 99) // 100 + 1
                        grams.append((own[np.argsort(late, kind="stable")] if late.any() else own)[:count])
                        owners.append(np.full(count, name[i]))
                        places.append((np.arange(count, dtype=np.int64) << 32) + size)
                if grams:
                    gram, owner = np.concatenate(grams), np.concatenate(owners)
                    level = parts[(gram & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.int64)
                    dealt = np.where(level > 0, (owner & ((1 << level) - 1)) + 1, 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in (gram.view(np.int64), dealt, owner, np.concatenate(places))],
                        ["gram", "part", "cls", "place"],
                    )

    return docs.select("text").mapInArrow(make, "gram bigint, part bigint, cls bigint, place bigint")


def with_hubs(grams: DataFrame) -> DataFrame:
    """Each class at an n-gram with the n-gram's hub: ``(gram, cls, place, hub, hub_place)``.

    The hub is the class that has the n-gram earliest, of several one by their
    hashes; it has no row of its own. The rows of an n-gram are laid out once.
    Each part of one that is dealt out has its own hub; there the hubs of parts
    have the first of them for their hub, and that one the second, so that all
    classes have a row.
    """
    earliest = F.shiftleft(F.least(F.shiftright("place", 32), F.lit((1 << 20) - 1)), 43).bitwiseOR(F.col("cls").bitwiseAND((1 << 43) - 1))
    by = Window.partitionBy("gram", "part").orderBy("key")
    rows = grams.withColumn("key", earliest)
    rows = rows.withColumns({"hub": F.first("cls").over(by), "hub_place": F.first("place").over(by), "before": F.lag("cls").over(by)})
    rows = rows.filter("before is null or before <> cls").drop("before")
    # Kept here, as both uses below would lay the n-grams out for themselves.
    rows = rows.filter("cls <> hub or part > 0").checkpoint()
    names = ["gram", "cls", "place", "hub", "hub_place"]
    by = Window.partitionBy("gram").orderBy("key")
    hubs = rows.filter("cls = hub").select("gram", "cls", "place", "key")
    first, place = F.first("cls").over(by), F.first("place").over(by)
    hubs = hubs.withColumns({"hub": first, "hub_place": place, "next": F.lead("cls").over(by), "next_place": F.lead("place").over(by)})
    top = F.col("cls") == F.col("hub")
    hubs = hubs.withColumns({"hub": F.when(top, F.col("next")).otherwise(F.col("hub")), "hub_place": F.when(top, F.col("next_place")).otherwise(F.col("hub_place"))})
    return rows.filter("cls <> hub").select(names).unionByName(hubs.filter("hub is not null").select(names))


def room(a: Column, b: Column, percent: int) -> Column:
    """Whether two sets whose first common n-gram has these places may overlap enough."""
    size_a, size_b = a.bitwiseAND(0xFFFFFFFF), b.bitwiseAND(0xFFFFFFFF)
    both = F.least(size_a - F.shiftright(a, 32), size_b - F.shiftright(b, 32))
    return both * (100 + percent) >= (size_a + size_b) * percent


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and bitmaps allow, from rows ``(a, n_a, bits_a, b, n_b, bits_b)``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")]
            good = pa.array([may_link(*x, percent) for x in zip(*columns, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(good)

    return pairs.mapInArrow(keep, "a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes that are similar enough.

    The sorted array of ``b`` goes to the hub ``a``. A hub with many members
    is dealt out over groups, its own array once for each. No text is looked
    at without pairs, which should be kept already.
    """
    if pairs.isEmpty():
        return pairs
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("groups"))
    spread = pairs.join(groups, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int"))
    members = spread.select(F.col("b").alias("cls"), "a", "salt", F.lit(1).alias("role"))
    hubs = groups.select(F.col("a").alias("cls"), "a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), F.lit(0).alias("role"))
    # A class's text is read once for all that ask for it: at most one place for each of its n-grams, or for 512 members.
    asked = members.unionByName(hubs).groupBy("cls").agg(F.collect_list(F.struct("a", "salt", "role")).alias("asks"))
    wanted = asked.join(reps.select("cls", "rep"), "cls").select(F.col("rep").alias("key"), "cls", "asks").checkpoint()
    if (wanted.agg(F.sum(F.size("asks"))).first()[0] or 0) <= ASKED:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "key").select("cls", "asks", "text")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Repeated rows have one array a task.
        seen: set[int] = set()
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                part = batch.slice(start, stop - start)
                made, begins = sets(part.column("text"), n)
                names, out = class_names(made, begins).tolist(), ([], [], [], [], [])
                for i, (cls, asks) in enumerate(zip(part.column("cls").to_pylist(), part.column("asks").to_pylist(), strict=True)):
                    # Two rows may share a key, with other texts.
                    if names[i] != cls or cls in seen:
                        continue
                    seen.add(cls)
                    array = made[begins[i] : begins[i + 1]].tobytes()
                    for ask in asks:
                        for column, x in zip(out, (ask["a"], ask["salt"], ask["role"], cls, array), strict=True):
                            column.append(x)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["a", "salt", "role", "cls", "held"])

    held = texts.mapInArrow(arrays, "a bigint, salt int, role int, cls bigint, held binary")
    met = held.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            found = []
            for a, cls, role, held in zip(*(batch.column(c).to_pylist() for c in ("a", "cls", "role", "held")), strict=True):
                array = np.frombuffer(held, dtype=np.uint64)
                if role == 0:
                    hub, own = a, array
                elif hub == a and linked(own, array, percent):
                    found.append((a, cls))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return met.select("a", "salt", "cls", "role", "held").mapInArrow(intersect, "a bigint, b bigint").distinct()


def _possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and bitmaps allow, kept."""
    return _bounded(_with_bits(_with_bits(pairs, reps, "a", "a"), reps, "b", "b"), percent).checkpoint()


def _same_id(known: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the classes of an id that has several texts."""
    ends = known.filter("doc_id is not null and cls is not null").groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("most"))
    several = ends.filter("a <> most").select("doc_id", "a")
    return known.join(several, "doc_id").filter("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def _in_components(rows: DataFrame, known: DataFrame, cls: str, name: str) -> DataFrame:
    """Adds the component of a class, itself if it has no links."""
    named = known.select(F.col("node").alias(cls), F.col("component").alias(name))
    return rows.join(named, cls, "left").withColumn(name, F.coalesce(name, cls))


def _stars(known: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join what the components join, one for each node but the smallest."""
    return known.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))


def _with_bits(rows: DataFrame, reps: DataFrame, cls: str, tag: str) -> DataFrame:
    known = reps.select(F.col("cls").alias(cls), F.col("n").alias(f"n_{tag}"), F.col("bits").alias(f"bits_{tag}"))
    return rows.join(known, cls)


def _telling(rows: DataFrame) -> DataFrame:
    """The n-grams ``(gram)`` at which pairs of ``rows (gram, cls, place, component)`` have to meet.

    Those with classes of several components, and of n-grams with the very
    same classes the first one in the common order: it is the first in each of
    their sets, so a pair that has room for a link behind any of them has it
    there. Near copies share most of their n-grams, so this leaves few. Sets
    of classes are told apart by their number and two 64-bit hashes.
    """
    one, two = F.bit_xor(F.xxhash64("cls")).alias("one"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("two")
    places = F.sum(F.shiftright("place", 32)).alias("places")
    torn = rows.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), one, two, places)
    first = F.min(F.struct("places", "gram"))["gram"].alias("gram")
    return torn.filter("low < high").groupBy("size", "one", "two").agg(first).select("gram")


def _tiled(rows: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share an n-gram, within tiles of neighbouring size bands.

    ``rows`` are ``(gram, cls, place, component, n, bits)``. A row stands in
    the tile of its band, and as a guest in the next band's. A tile of more
    than ``tile`` rows is dealt out over blocks: each pair of blocks is a tile
    of its own, in which rows of the one meet rows of the other.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    native = rows.withColumns({"band": band, "guest": F.lit(0)})
    guests = native.withColumns({"band": F.col("band") + 1, "guest": F.lit(1)})
    tiles = native.unionByName(guests)
    large = tiles.groupBy("gram", "band").agg(F.count("*").alias("size")).filter(F.col("size") > tile)
    large = large.select("gram", "band", F.ceil(F.col("size") / tile).cast("int").alias("blocks")).checkpoint()
    blocks = F.coalesce("blocks", F.lit(1))
    # Three numbers a large tile; the rows, which carry bitmaps, are not shuffled for them unless they are very many.
    tiles = tiles.join(F.broadcast(large) if large.count() <= ASKED else large, ["gram", "band"], "left").withColumn("block", F.pmod(F.xxhash64("cls", F.lit(7)), blocks).cast("int"))
    tiles = tiles.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tiles = tiles.withColumns({"one": F.least("block", "with"), "two": F.greatest("block", "with")}).drop("blocks", "with")
    at = ["gram", "band", "one", "two"]
    tiles = tiles.repartition(*at).sortWithinPartitions(*at, "guest", "cls")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, natives, bits = None, np.zeros((5, 0), dtype=np.int64), []
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in at], axis=1)
            guest, size, place = (batch.column(c).to_numpy() for c in ("guest", "n", "place"))
            block = batch.column("block").to_numpy().astype(np.int64)
            # Rows of one block meet each other in the tile of that block alone.
            block = np.where(key[:, 2] == key[:, 3], -1 - np.arange(len(block)), block)
            rows = np.stack([batch.column("cls").to_numpy(), batch.column("component").to_numpy(), size, size - (place >> 32), block])
            held = batch.column("bits").to_pylist()
            found = set()
            heads = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *heads.tolist()], [*heads.tolist(), len(key)], strict=True):
                if start == stop:
                    continue
                if tuple(key[start]) != here:
                    here, natives, bits = tuple(key[start]), natives[:, :0], []
                before = natives.shape[1]
                own = start + int(np.count_nonzero(guest[start:stop] == 0))
                natives, bits = np.concatenate([natives, rows[:, start:own]], axis=1), bits + held[start:own]
                for first in range(start, stop, ROWS):
                    part = rows[:, first : min(first + ROWS, stop)]
                    for i, j in _close(part, natives, before + first - start, percent):
                        cls, other = int(part[0, i]), int(natives[0, j])
                        pair = (min(cls, other), max(cls, other))
                        if pair not in found and may_link(int(part[2, i]), held[first + i], int(natives[2, j]), bits[j], percent):
                            found.add(pair)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    tiles = tiles.select(*at, "guest", "block", "cls", "place", "component", "n", "bits")
    return tiles.mapInArrow(meet, "a bigint, b bigint").distinct()


def _close(rows: np.ndarray, natives: np.ndarray, first: int, percent: int) -> Iterator[tuple[int, int]]:
    """Indices of rows and of the tile's natives before them that are in other components and have room for a link.

    Both are ``(cls, component, size, n-grams from the shared one on, block)``;
    ``first`` is the tile's number of the first row. Negative blocks are rows
    that meet all others.
    """
    (cls, component, size, left, block), (others, apart, sizes, lefts, blocks) = rows[:, :, None], natives[:, None, :]
    good = (component != apart) & (cls != others) & (np.arange(len(natives[0])) < first + np.arange(len(rows[0]))[:, None])
    good &= np.minimum(left, lefts) * (100 + percent) >= (size + sizes) * percent
    good &= (block < 0) | (block != blocks)
    yield from zip(*(x.tolist() for x in np.nonzero(good)), strict=True)


def join(docs: DataFrame, n: int = 5, percent: int = 80, together: int = TOGETHER, tile: int = TILE) -> DataFrame:
    """The component of every document: ``(doc_id, n_shingles, component_id, key, component)``.

    Two documents are linked if the overlap of their sets of distinct word
    n-grams is at least ``percent`` hundredths of their union; the component
    is the smallest doc_id that links reach. A document without words, or with
    a null text, has no n-grams and is its own component. Repeated rows come
    out as often as they came in. Rows of one id with different texts link
    what either links. A row without an id links as others do; its component
    is null only if no row of the component has an id. An empty table gives no
    rows; other columns are not looked at. Sets are told apart by 64-bit
    hashes, and a set's text is found again by ``key``, a 64-bit hash of id
    and text. ``component`` names the component by the hash of one of its
    sets, whether its rows have ids or not; it is null without words.

    ``together`` and ``tile`` say how many rows of an n-gram are worked on in
    one task; beyond them they are dealt out, with the same result.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    reach_workers(spark)
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    known = classes(docs, n).checkpoint()
    reps = known.filter("cls is not null").groupBy("cls").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")).checkpoint()
    grams = first_grams(docs, n, percent, *sketch(docs, n, together))
    shared = with_hubs(grams).withColumn("near", room(F.col("place"), F.col("hub_place"), percent)).drop("hub_place")

    # One pair a class: with the hub that it meets at most of its n-grams.
    counted = shared.filter("near").groupBy("cls", "hub").agg(F.count("*").alias("n"))
    stars = counted.groupBy(F.col("cls").alias("b")).agg(F.max_by("hub", F.struct("n", "hub")).alias("a"))
    stars = stars.select("a", "b").checkpoint()
    first = _verified(_possible(stars, reps, percent), docs, reps, n, percent).unionByName(_same_id(known))
    first = components(first).checkpoint()
    let_go(spark)

    # Then the pairs with other hubs, where they are not in one component already.
    placed = _in_components(_in_components(shared, first, "cls", "own"), first, "hub", "other").checkpoint()
    apart = placed.filter("near and own <> other").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    apart = apart.join(stars, ["a", "b"], "left_anti").checkpoint()
    second = components(_stars(first).unionByName(_verified(_possible(apart, reps, percent), docs, reps, n, percent))).checkpoint()
    let_go(spark)

    # What is left are pairs of other classes at an n-gram, if in different components.
    torn = placed.groupBy("gram").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low < high").select("gram")
    rest = _in_components(placed.join(torn, "gram").select("gram", "cls", "place").distinct(), second, "cls", "component").checkpoint()
    rest = rest.join(_telling(rest), "gram")
    more = _tiled(rest.join(reps.select("cls", "n", "bits"), "cls"), percent, tile)
    tested = stars.unionByName(apart).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = more.join(tested, ["a", "b"], "left_anti").checkpoint()
    let_go(spark)
    more = _verified(more, docs, reps, n, percent)

    joined = components(_stars(second).unionByName(more)).withColumnsRenamed({"node": "cls", "component": "group"})
    named = known.join(joined, "cls", "left").withColumn("group", F.coalesce("group", "cls"))
    least = named.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    full = named.join(least, "group", "left")
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return full.select("doc_id", F.col("n").alias("n_shingles"), component, "key", F.col("group").alias("component"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stands for each component of :func:`join`.

    The one with the smallest id stays, of several rows with it one by the
    hash of its text, of equal rows any; a row without an id stays where no
    other has one. Rows without words all stay.
    """
    spare = "_key"
    while any(c.lower().startswith(spare) for c in docs.columns):
        spare = "_" + spare
    groups = join(docs, n, percent)
    first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "key"))["key"]
    chosen = groups.filter("component is not null").groupBy("component").agg(first.alias(spare)).select(spare, F.lit(True).alias(spare + "_one"))
    empty = groups.filter("component is null").select(F.col("key").alias(spare)).distinct().withColumn(spare + "_one", F.lit(False))
    kept = docs.withColumn(spare, F.xxhash64("doc_id", "text")).join(chosen.unionByName(empty), spare)
    kept = kept.withColumn(spare + "_n", F.row_number().over(Window.partitionBy(spare).orderBy(spare)))
    return kept.filter((F.col(spare + "_n") == 1) | ~F.col(spare + "_one")).select(*docs.columns)
