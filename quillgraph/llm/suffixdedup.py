"""Exact removal of long repeated byte strings with families of suffix arrays.

Of all positions, few need a suffix. A string of ``length`` bytes is known by
its anchor: the leftmost smallest of the hashes of its ``gram``-byte pieces.
Equal strings have equal anchors at equal places, so each start of a string
belongs to one anchor, about one in a hundred and fifty positions, and only
anchors with equal pieces can start equal strings.

1. Anchors whose whole surroundings occur again are settled by hash, so a
   passage that very many documents share is settled by counting.
2. The others, at the edges of repeats, meet by their piece. There a
   logarithmic index family takes them in batches: a batch becomes a suffix
   array, is merge-scanned against the arrays of all levels for matches long
   enough to both sides of the anchor, and levels of like size are merged.
3. A piece with very many different surroundings is dealt out instead by the
   hashes of its single strings.

Repeated runs of words are found in the same way: each word becomes a code of
``CODE`` bytes, and strings of whole codes are looked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import WORD, let_go, reach_workers, slices
from quillgraph.llm.rolling import Ranges, buffer
from quillgraph.operators.skew import salted_join
from quillgraph.sources.shared import shared_dir

#: Bytes of a repeated string, and of the pieces that are hashed for anchors.
LENGTH, GRAM = 400, 100
#: Bytes of a word's code, and the largest share of a repeated run's words in the pieces that are hashed for its anchors.
CODE, WORD_GRAM = 6, 0.32
#: Bytes of text that are hashed at once, and suffixes of a batch.
PART, BATCH = 1 << 20, 4096
#: Anchors of one piece that are joined in one task.
TOGETHER = 50_000
#: Hashes of texts that occur more than once and are broadcast, 8 bytes each.
COPIES = 1_000_000
#: Different surroundings of one piece that one task compares; more are dealt out.
HOT = 20_000
#: Bits of the distance from a run's first start to its last and to its anchor, in one number with that start.
OFFSET = 12

_GRAM_BASE, _CTX_BASE, _OTHER_BASE = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
_WORD_BASE = 0xA0761D6478BD642F
_WORDS = re.compile(WORD.encode())


def anchors(texts: pa.Array, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of starts with one anchor: ``(text, low, high, at, piece, surroundings)``.

    Starts ``low`` to ``high`` of a text, in bytes, have their anchor ``at``.
    Surroundings are the hash of all bytes of these strings and of where the
    anchor lies in them.
    """
    raw, ends = buffer(texts)
    width = length - gram + 1
    none = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(raw) < length:
        return none
    n = len(raw) - gram + 1
    pieces = Ranges(raw, _GRAM_BASE).of(slice(0, n), slice(gram, gram + n))
    padded = np.concatenate([pieces, np.full(-n % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[:starts]
    whole = np.flatnonzero(ends[owner + 1] - np.arange(starts) >= length)
    if not len(whole):
        return none
    value = least[whole]
    new = np.ones(len(whole), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (np.diff(whole) != 1) | (owner[whole[1:]] != owner[whole[:-1]])
    cuts = np.flatnonzero(new)
    low, high, piece = whole[cuts], whole[np.append(cuts[1:], len(whole)) - 1], value[cuts]
    at = np.array([a + int((pieces[a : a + width] == p).argmax()) for a, p in zip(low.tolist(), piece, strict=True)], dtype=np.int64)
    torn = np.flatnonzero(at < high)
    if len(torn):  # the same piece again within reach: starts beyond the first have a later anchor
        kept = np.setdiff1d(np.arange(len(low)), torn, assume_unique=True)
        runs = [[low[kept]], [high[kept]], [at[kept]], [piece[kept]]]
        for i in torn.tolist():
            a, b, p = int(low[i]), int(high[i]), piece[i]
            places = a + np.flatnonzero(pieces[a : b + width] == p)
            places = places[: int(np.searchsorted(places, b)) + 1]
            first = np.concatenate([[a], places[:-1] + 1])
            for held, x in zip(runs, (first, np.minimum(places, b), places, np.full(len(places), p)), strict=True):
                held.append(x)
        low, high, at, piece = (np.concatenate(x) for x in runs)
    own = owner[low]
    with np.errstate(over="ignore"):
        around = Ranges(raw, _CTX_BASE).of(low, high + length) ^ ((at - low).astype(np.uint64) * np.uint64(_OTHER_BASE))
    base = ends[own]
    return own, low - base, high - base, at - base, piece, around


def _anchor_rows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                own, low, high, at, piece, around = anchors(batch.column("text").slice(start, stop - start), length, gram)
                key = batch.column("key").slice(start, stop - start).take(pa.array(own, pa.int64()))
                place = low << 2 * OFFSET | (high - low) << OFFSET | at - low
                yield pa.RecordBatch.from_arrays(
                    [key, pa.array(place, pa.int64()), *(pa.array(x.view(np.int64), pa.int64()) for x in (piece, around))],
                    ["key", "place", "piece", "around"],
                )

    return keyed.mapInArrow(make, "key bigint, place bigint, piece bigint, around bigint")


def _low(place: Column) -> Column:
    return F.shiftright(place, 2 * OFFSET)


def _high(place: Column) -> Column:
    return _low(place) + F.shiftright(place, OFFSET).bitwiseAND((1 << OFFSET) - 1)


def _at(place: Column) -> Column:
    return _low(place) + place.bitwiseAND((1 << OFFSET) - 1)


def _common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row of a sorted byte-string column shares with the one before; 0 for the first."""
    width = rows.dtype.itemsize
    letters = rows.view(np.uint8).reshape(len(rows), width)
    shared = np.zeros(len(rows), dtype=np.int64)
    for a in range(1, len(rows), 8192):
        b = min(len(rows), a + 8192)
        apart = letters[a:b] != letters[a - 1 : b - 1]
        shared[a:b] = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    return shared


class Level:
    """A suffix array: what follows each anchor, sorted, with what comes before it, reversed."""

    def __init__(self, right: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, name: np.ndarray) -> None:
        order = np.argsort(right, kind="stable")
        self.right, self.left, self.low, self.high, self.name = (x[order] for x in (right, left, low, high, name))

    def __len__(self) -> int:
        return len(self.right)

    def merged(self, other: Level) -> Level:
        # The stable sort is a merge sort that finds ascending runs, of which there are two: it merges them in one go.
        columns = ("right", "left", "low", "high", "name")
        return Level(*(np.concatenate([getattr(self, c), getattr(other, c)]) for c in columns))

    def matches(self, length: int, gram: int) -> Iterator[tuple[np.ndarray, int]]:
        """Names of those whose string that starts ``o`` bytes before the anchor is in the array twice, and ``o``, for each ``o``."""
        n = len(self)
        shared = _common(self.right)
        group = np.cumsum(shared < gram)
        order = np.lexsort((self.left, group))
        before = _common(self.left[order])
        before[1:][np.diff(group[order]) != 0] = 0
        reach_right = np.maximum(shared, np.append(shared[1:], 0))
        reach_left = np.empty(n, dtype=np.int64)
        reach_left[order] = np.maximum(before, np.append(before[1:], 0))
        first, last = np.maximum(self.low, length - reach_right), np.minimum(self.high, reach_left)
        # Only those that may match anything stay, with the least that neighbours share across the gaps.
        may = np.flatnonzero(first <= last)
        if len(may) < 2:
            return
        first, last, name = first[may], last[may], self.name[may]
        shared = np.minimum.reduceat(shared[: may[-1] + 1], np.append(0, may[:-1] + 1))
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        spot = np.sort(place[may])
        back = np.searchsorted(spot, place[may])
        before = np.minimum.reduceat(before[: spot[-1] + 1], np.append(0, spot[:-1] + 1))
        for o in range(int(first.min()), int(last.max()) + 1):
            now = np.flatnonzero((first <= o) & (o <= last))
            if len(now) < 2:
                continue
            right = np.cumsum(shared < length - o)[now]
            left = np.cumsum(before < max(o, 1))[back][now] if o else 0
            both = right * (len(may) + 1) + left
            _, where, counts = np.unique(both, return_inverse=True, return_counts=True)
            again = counts[where] > 1
            if again.any():
                yield name[now[again]], o


class Family:
    """Suffix arrays of sizes that grow geometrically, and which strings were found twice."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.levels: list[Level] = []
        self.found = np.zeros((0, length - gram + 1), dtype=bool)

    def _scan(self, level: Level) -> None:
        for names, o in level.matches(self.length, self.gram):
            self.found[names, o] = True

    def add(self, bodies: list[bytes], before: list[int]) -> None:
        """Takes a batch: the bytes of each anchor's strings, and how many of them come before the anchor."""
        reach, first = self.length - self.gram, len(self.found)
        right = np.array([b[k:] for b, k in zip(bodies, before, strict=True)], dtype=f"S{self.length}")
        left = np.array([b[:k][::-1] for b, k in zip(bodies, before, strict=True)], dtype=f"S{reach}")
        high = np.array(before, dtype=np.int64)
        low = high - (np.array([len(b) for b in bodies], dtype=np.int64) - self.length)
        self.found = np.concatenate([self.found, np.zeros((len(bodies), reach + 1), dtype=bool)])
        new = Level(right, left, low, high, np.arange(first, first + len(bodies)))
        self._scan(new)
        for level in self.levels:
            self._scan(level.merged(new))
        while self.levels and len(self.levels[-1]) <= len(new):
            new = self.levels.pop().merged(new)
        self.levels.append(new)


def _spans(found: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and stop of the bytes that the found strings cover."""
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    return row, at[row] - (stop - 1), at[row] - first + length


def _edge_spans(edges: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeats among rows ``(piece, key, before, at, body)`` of like pieces, one family of suffix arrays a task."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, keys, places = Family(length, gram), [], []
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                family.add(part.column("body").to_pylist(), part.column("before").to_pylist())
                keys.append(part.column("key").to_numpy())
                places.append(part.column("at").to_numpy())
        if keys:
            row, start, stop = _spans(family.found, np.concatenate(places).astype(np.int64), length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)[row], pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], ["key", "start", "stop"]
            )

    return edges.select("piece", "key", "before", "at", "body").repartition("piece").mapInArrow(match, "key bigint, start int, stop int")


def _hot_spans(edges: DataFrame, length: int) -> DataFrame:
    """The same for pieces with very many surroundings: every string by two hashes, counted by group."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, before, at, body in zip(*(batch.column(c).to_pylist() for c in ("key", "before", "at", "body")), strict=True):
                raw = np.frombuffer(body, dtype=np.uint8)
                n = len(raw) - length + 1
                one, two = (Ranges(raw, base).of(slice(0, n), slice(length, length + n)).view(np.int64) for base in (_CTX_BASE, _OTHER_BASE))
                start = at - before + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(np.full(n, key), pa.int64()), pa.array(start, pa.int32())],
                    ["one", "two", "key", "start"],
                )

    rows = edges.select("key", "before", "at", "body").mapInArrow(strings, "one bigint, two bigint, key bigint, start int")
    again = rows.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(again, ["one", "two"]).select("key", "start", (F.col("start") + length).alias("stop"))


def repeats(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Byte ranges ``(key, start, stop)`` of rows ``(key, text)`` that repeated strings cover; they may overlap."""
    if length - gram >= 1 << OFFSET:
        raise ValueError(f"strings of {length} bytes need pieces of {length - (1 << OFFSET) + 1} bytes at least")
    rows = _anchor_rows(keyed, length, gram).checkpoint()
    again = rows.groupBy("piece").agg(F.count("*").alias("n")).filter("n > 1")
    rows = salted_join(rows, again, "piece", "key", "n", hot_rows=TOGETHER).drop("n").checkpoint()
    around = rows.groupBy("piece", "around").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")).checkpoint()
    spot = F.struct("piece", "around").alias("spot")
    settled = salted_join(rows.select(spot, "key", "place"), around.filter("n > 1").select(spot, "n"), "spot", "key", "n", hot_rows=TOGETHER)
    settled = settled.select("key", _low(F.col("place")).cast("int").alias("start"), (_high(F.col("place")) + length).cast("int").alias("stop"))
    mixed = around.groupBy("piece").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    edges = around.join(mixed, "piece").select("piece", "kinds", "one.*")
    place = F.col("place")
    edges = edges.select("piece", "kinds", "key", _low(place).alias("low"), _high(place).alias("high"), _at(place).alias("at"))
    asked = edges.groupBy("key").agg(F.collect_list(F.struct("piece", "kinds", "low", "high", "at")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for key, text, wanted in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("asked").to_pylist(), strict=True):
                raw = text.as_buffer()
                for a in wanted:
                    body = raw[a["low"] : a["high"] + length].to_pybytes()
                    for held, x in zip(out, (a["piece"], a["kinds"], key, a["at"] - a["low"], a["at"], body), strict=True):
                        held.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["piece", "kinds", "key", "before", "at", "body"])

    met = keyed.join(asked, "key").select("key", "text", "asked")
    edges = met.mapInArrow(cut, "piece bigint, kinds bigint, key bigint, before int, at int, body binary").checkpoint()
    near = _edge_spans(edges.filter(F.col("kinds") <= hot), length, gram)
    return settled.unionByName(near).unionByName(_hot_spans(edges.filter(F.col("kinds") > hot), length))


def word_codes(texts: pa.Array) -> pa.Array:
    """Each text as the codes of its words, one after the other, without what is between them."""
    raw, ends = buffer(texts)
    inside = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[ends] = True
    before, after = np.append(False, inside[:-1])[: len(raw)], np.append(inside[1:], False)[: len(raw)]
    starts, stops = np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1
    codes = Ranges(raw, _WORD_BASE).of(starts, stops).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE]
    cuts = (np.searchsorted(starts, ends) * CODE).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(codes.tobytes())])


def repeated_words(keyed: DataFrame, words: int, hot: int = HOT) -> DataFrame:
    """Ranges of words ``(key, start, stop)`` of rows ``(key, text)`` that repeated runs of ``words`` words cover; they may overlap.

    White space between words is not compared.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), PART):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column("key"), word_codes(part.column("text"))], ["key", "text"])

    length = words * CODE
    found = repeats(keyed.mapInArrow(code, "key bigint, text binary"), length, max(1, int(words * WORD_GRAM)) * CODE, hot)
    # Starts between codes are no runs of words.
    first, last = F.ceil(F.col("start") / CODE).cast("int"), F.floor((F.col("stop") - length) / CODE).cast("int")
    return found.filter(first <= last).select("key", first.alias("start"), (last + words).alias("stop"))


def _with_found(docs: DataFrame, length: int, gram: int, hot: int, words: int | None, name: str) -> DataFrame:
    """``docs`` with the ranges that repeated strings cover in each text as ``name``: ``(start, stop, worded)``, null if none.

    Texts too short for any repeat go past everything. Equal texts are worked
    on once: all that is long enough of a text that occurs more than once is
    repeated, so its rows meet no join, and one of them stands for it against
    the others. Which texts those are goes to the rows as 64-bit hashes, by
    broadcast up to COPIES of them.
    """
    key, nth = name + "_key", name + "_nth"
    bytes_ = F.octet_length("text")
    least = min(length, 2 * words - 1) if words else length
    keyed = docs.withColumn(key, F.xxhash64("text"))
    long, short = keyed.filter(bytes_ >= least), keyed.filter(F.coalesce(bytes_, F.lit(0)) < least)
    repeated = long.groupBy(key).agg(F.count("*").alias(nth)).filter(F.col(nth) > 1).select(key).checkpoint()
    n = repeated.count()
    if n <= COPIES:
        repeated = F.broadcast(repeated)
    single = long.join(repeated, key, "left_anti") if n else long
    texts = single.select(F.col(key).alias("key"), "text")
    if n:
        several = long.join(repeated, key, "left_semi")
        first = F.row_number().over(Window.partitionBy("key").orderBy("key"))
        one = several.select(F.col(key).alias("key"), "text").withColumn("nth", first).filter("nth = 1").drop("nth")
        texts = texts.unionByName(one)
    found = repeats(texts, length, gram, hot).withColumn("worded", F.lit(False))
    if words:
        let_go(docs.sparkSession)
        found = found.unionByName(repeated_words(texts, words, hot).withColumn("worded", F.lit(True)))
    per_text = found.groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("start", "stop", "worded")).alias(name))
    none = F.lit(None).cast(per_text.schema[name].dataType)
    out = single.join(per_text, key, "left").unionByName(short.withColumn(name, none))
    if n:

        def span(stop: Column, worded: bool) -> Column:
            return F.struct(F.lit(0).alias("start"), stop.cast("int").alias("stop"), F.lit(worded).alias("worded"))

        whole = F.when(bytes_ >= length, F.array(span(bytes_, False))).otherwise(F.array().cast(per_text.schema[name].dataType))
        # All words, if they are enough; how many there are is seen where they are taken out.
        whole = F.concat(whole, F.array(span(F.lit(2**31 - 1), True))) if words else whole
        out = out.unionByName(several.withColumn(name, whole))
    return out.drop(key)


CUT = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:int,stop:int>>, kept binary"


def _cut(words: int | None):
    """A function of text and ranges found that takes them out: a struct of CUT."""

    @F.arrow_udf(CUT)
    def cut(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in parts:
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, spans in zip(texts, found.to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                worded = join_spans([(s["start"], s["stop"]) for s in spans or () if s["worded"]])
                places = [m.span() for m in _WORDS.finditer(raw)] if worded else []
                covered = [(places[a][0], places[min(b, len(places)) - 1][1]) for a, b in worded if min(b, len(places)) - a >= (words or 0)]
                joined = join_spans([*((s["start"], s["stop"]) for s in spans or () if not s["worded"]), *covered])
                kept, at = [], 0
                for a, b in joined:
                    kept.append(raw[at:a])
                    at = b
                whole = b"".join([*kept, raw[at:]])
                for held, x in zip(out, (len(raw), len(raw) - len(whole), len(joined), [{"start": a, "stop": b} for a, b in joined], whole), strict=True):
                    held.append(x)
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.binary())
            yield pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return cut


def _spare(docs: DataFrame, name: str) -> str:
    """A name that begins no column of ``docs``."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name = "_" + name
    return name


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int | None = None) -> DataFrame:
    """Every row with the bytes that no repeated string covers: ``(doc_id, n_bytes, n_removed, n_spans, spans, kept)``.

    A string of ``length`` bytes is repeated if it starts anywhere else too,
    in the same text or another; all copies go, overlapping ones included.
    ``spans`` are the maximal removed ranges in bytes, ``kept`` the other bytes
    put together, which need not be whole characters. A null text is empty;
    texts shorter than ``length`` stay whole; repeated rows repeat each other;
    an empty table gives no rows; other columns are not looked at. Texts are
    told apart by a 64-bit hash, equal surroundings by two.

    With ``words``, runs of so many words that also start elsewhere go too,
    from the first letter to the last, however short in bytes and whatever
    white space is between their words. Words are told apart by 48 bits of
    hash.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    reach_workers(spark)
    rows = _with_found(docs.select("doc_id", "text"), length, gram, hot, words, "found")
    return rows.select("doc_id", _cut(words)("text", "found").alias("cut")).select("doc_id", "cut.*")


def without_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with what :func:`remove_repeats` leaves of their texts.

    Characters cut in half go with the cut. Texts of which nothing but blanks
    is left go, those without a repeat stay as they are; ``n_chars``, if
    there, is counted anew where a text was cut.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    reach_workers(spark)
    name = _spare(docs, "_found")
    rows = _with_found(docs, length, GRAM, HOT, words, name).withColumn(name, _cut(words)("text", name))
    removed, kept = F.col(f"{name}.n_removed") > 0, F.col(f"{name}.kept").cast("string")
    left = F.coalesce(F.try_validate_utf8(kept), F.regexp_replace(F.make_valid_utf8(kept), "\ufffd", ""))
    rows = rows.withColumn("text", F.when(removed, left).otherwise(F.col("text"))).filter(~removed | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(removed, counted).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges that the given ones cover."""
    joined: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            if b > joined[-1][1]:
                joined[-1] = (joined[-1][0], b)
        else:
            joined.append((a, b))
    return joined
