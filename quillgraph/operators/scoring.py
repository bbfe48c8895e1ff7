"""Sentences scored where their document lies.

Which frame was made from which is noted here, so that an operator can see
that its inputs belong to the same records. A frame derived from a noted one
has no note, and takes the way of joins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TypeVar
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.functions.utf8 import lax_words, sentence_list, strict_words
from quillgraph.operators.records import Frequencies, own_terms
from quillgraph.sources.shared import reach_workers

# Bytes of text whose rows are handed on at once.
BATCH_BYTES = 4 << 20

T = TypeVar("T")
_notes: WeakKeyDictionary[DataFrame, object] = WeakKeyDictionary()


@dataclass(eq=False)
class Chosen:
    """One text per id; the records as they are where ``articles`` names them."""

    articles: DataFrame | None


@dataclass(eq=False)
class Cut:
    """The sentences of these articles."""

    articles: DataFrame


@dataclass(eq=False)
class OwnWeights:
    """The TF·IDF of articles with ids of their own."""

    articles: DataFrame
    found: Frequencies
    compat: bool


@dataclass(eq=False)
class Scores:
    """Scores of these sentences; ``rows`` gives them with the sentence or without."""

    sentences: DataFrame
    rows: Callable[[bool], DataFrame]


def noted(df: DataFrame, note: object) -> DataFrame:
    _notes[df] = note
    return df


def note_of(df: DataFrame, kind: type[T]) -> T | None:
    note = _notes.get(df)
    return note if isinstance(note, kind) else None


class Weights:
    """The weights of one document by word; a word given several times has all of them."""

    def __init__(self) -> None:
        self.first: dict[bytes, float] = {}
        self.more: dict[bytes, list[float]] = {}
        self.nan = False

    def add(self, word: bytes, weight: float) -> None:
        self.nan |= weight != weight
        if word in self.first:
            self.more.setdefault(word, []).append(weight)
        else:
            self.first[word] = weight

    def score(self, sentence: bytes, n: int) -> float:
        """The ``n`` best distinct words and what ties with the last, added from the largest down."""
        first, words = self.first, {*strict_words(sentence)}
        found = [first[word] for word in words if word in first]
        if self.more:
            found += [x for word in words for x in self.more.get(word, ())]
        if self.nan and any(x != x for x in found):
            return math.nan
        found.sort(reverse=True)
        best = found[:n]
        if len(found) > n and found[n] == found[n - 1]:
            best += [x for x in found[n:] if x == found[n]]
        # Not sum(), which adds with a correction.
        total = 0.0
        for weight in best:
            total += weight
        return total


def own_weights(text: bytes, lax: bytes | None, idf: Callable[[bytes, float], float], lone: float) -> Weights:
    """TF·IDF inside a record, as ``tf_idf`` has it; ``lax`` is given where TF goes by the lax words.

    ``idf`` gives the value of a strict word, ``lone`` where it does not know the word.
    """
    found, strict = Weights(), Counter(strict_words(text))
    counts = strict if lax is None else Counter(lax_words(lax))
    most = max(counts.values(), default=1)
    by_count = {n: 0.5 + 0.5 * (n / most) for n in {*counts.values()}}
    if lax is None:
        found.first = {word: by_count[n] * idf(word, lone) for word, n in strict.items()}
    else:
        found.first = {word: by_count[n] for word, n in counts.items()}
        found.first |= {word: found.first.get(word, 1.0) * idf(word, lone) for word in strict}
    return found


def unpacked(packs: list[dict]) -> Weights:
    found = Weights()
    for pack in packs:
        values = memoryview(pack["weights"]).cast("d")
        for word, weight in zip(pack["words"].split(), values, strict=True):
            found.add(word, weight)
    return found


def packed(weights: DataFrame) -> DataFrame:
    """Weights of neighbouring rows of a document as one row: ``(doc_id, words, weights)``.

    Only words that a sentence may hold, which are ASCII letters and digits.
    """
    reach_workers(weights.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.ascii_is_alnum(batch.column("unigram")))
            if not batch.num_rows:
                continue
            ids, words, values = (batch.column(name) for name in ("doc_id", "unigram", "tfidf"))
            new = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1]).astype(np.int32)
            ends = np.append(starts, len(ids)).astype(np.int32)
            numbers = values.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(starts)),
                    pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), words), " ").cast(pa.binary()),
                    pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends * np.int32(8)), pa.py_buffer(np.ascontiguousarray(numbers))]),
                ],
                ["doc_id", "words", "weights"],
            )

    known = weights.filter("doc_id is not null and unigram is not null and tfidf is not null")
    rows = known.select("doc_id", F.col("unigram").cast("string").alias("unigram"), F.col("tfidf").cast("double").alias("tfidf"))
    kind = weights.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(pack, f"doc_id {kind}, words binary, weights binary")


def scored_in_record(sentences: DataFrame, weights: DataFrame, n: int) -> DataFrame | None:
    """Scores of the sentences of articles with ids of their own: ``(doc_id, pos, score)``, None of others.

    Weights that are known to be the TF·IDF of the same records are made
    there: frequent words meet their frequency by broadcast, and a record that
    holds rare words of several documents gets those by a shuffle. Nothing
    else is shuffled. Other weights are packed and meet their document.
    """
    cut = note_of(sentences, Cut)
    if cut is None or n < 1:
        return None
    articles, chosen = cut.articles, note_of(cut.articles, Chosen)
    if chosen is None and not _ids_of_their_own(articles):
        return None
    own = note_of(weights, OwnWeights)
    if own is not None and own.articles is (articles if chosen is None else chosen.articles):
        rows = _with_frequencies(articles, own, n)
    else:
        rows = _with_packed(articles, weights, n)
    return noted(rows(False), Scores(sentences, rows))


def _ids_of_their_own(articles: DataFrame) -> bool:
    """If no two articles share an id, and none lacks one."""
    ids = articles.groupBy("doc_id").agg(F.count("*").alias("n"))
    found = ids.agg(F.max("n").alias("most"), F.count_if(F.col("doc_id").isNull()).alias("none")).first()
    return (found.most or 0) <= 1 and not found.none


def _with_frequencies(articles: DataFrame, own: OwnWeights, n: int) -> Callable[[bool], DataFrame]:
    found, spark = own.found, articles.sparkSession
    listed = found.listed().select(F.col("unigram").cast("binary"), found.idf(F.col("df")).alias("idf")).toArrow()
    lone = spark.range(1).select(found.idf(F.lit(1).cast("bigint"))).first()[0]
    known = spark.sparkContext.broadcast(dict(zip(listed[0].to_pylist(), listed[1].to_pylist(), strict=True)))
    text = F.col("text")
    lax = tx.reduced(text, compat=True).cast("binary") if own.compat else F.lit(None).cast("binary")
    docs = articles.select("doc_id", text.cast("binary").alias("text"), lax.alias("lax"))
    if not found.rest_is_lone:
        met = own_terms(articles).join(F.broadcast(found.listed()), "unigram", "left_anti").join(found.rest().filter("df > 1"), "unigram")
        word = F.struct(F.col("unigram").cast("binary").alias("word"), found.idf(F.col("df")).alias("idf"))
        docs = docs.join(met.groupBy("doc_id").agg(F.collect_list(word).alias("far")), "doc_id", "left")

    def weigh(row: dict) -> Weights:
        near, idf = known.value, known.value.get
        if row.get("far"):
            far = {x["word"]: x["idf"] for x in row["far"]}
            idf = lambda word, lone: near[word] if word in near else far.get(word, lone)
        return own_weights(row["text"], row["lax"], idf, lone)

    return lambda with_sentence: _score_rows(docs, weigh, n, with_sentence)


def _with_packed(articles: DataFrame, weights: DataFrame, n: int) -> Callable[[bool], DataFrame]:
    packs = packed(weights).groupBy("doc_id").agg(F.collect_list(F.struct("words", "weights")).alias("packs"))
    docs = articles.select("doc_id", F.col("text").cast("binary").alias("text")).join(packs, "doc_id", "left")
    return lambda with_sentence: _score_rows(docs, lambda row: unpacked(row["packs"] or []), n, with_sentence)


def _score_rows(docs: DataFrame, weigh: Callable[[dict], Weights], n: int, with_sentence: bool) -> DataFrame:
    reach_workers(docs.sparkSession)

    def batch_of(ids: pa.Array, at: list[int], pos: list[int], pieces: list[bytes], scores: list[float]) -> pa.RecordBatch:
        columns = {"doc_id": ids.take(pa.array(at, pa.int32())), "pos": pa.array(pos, pa.int32())}
        if with_sentence:
            columns["sentence"] = pa.array(pieces, pa.binary())
        return pa.RecordBatch.from_pydict(columns | {"score": pa.array(scores, pa.float64())})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, (at, pos, found, scores) = batch.column("doc_id"), 0, ([], [], [], [])
            others = [name for name in batch.schema.names if name != "doc_id"]
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in others}
                if row["text"] is None:
                    continue
                weights, pieces = weigh(row), sentence_list(row["text"])
                at += [i] * len(pieces)
                pos += range(len(pieces))
                found += pieces
                scores += [weights.score(x, n) for x in pieces]
                held += len(row["text"])
                if held > BATCH_BYTES:
                    yield batch_of(ids, at, pos, found, scores)
                    held, (at, pos, found, scores) = 0, ([], [], [], [])
            yield batch_of(ids, at, pos, found, scores)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(score, f"doc_id {kind}, pos int, {'sentence binary, ' if with_sentence else ''}score double")
    return out.withColumn("sentence", F.col("sentence").cast("string")) if with_sentence else out
