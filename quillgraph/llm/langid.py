"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every document that may be learned from is counted: tasks add up the n-grams
of their documents by language and hash bucket, Spark adds up the tasks. The
log-probabilities form one matrix of buckets and languages, whose size does
not grow with the corpus; it is broadcast, and texts are scored by gathering
the rows of their n-grams and adding them up by document.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import reach_workers, slices
from quillgraph.sources.shared import shared_dir

#: Lengths of n-grams, and hash buckets they fall into.
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Languages that a model may have: more are no languages, and the matrix would outgrow its bound of half a gigabyte.
LANGUAGES = 1000
#: Added to each count.
SMOOTHING = 0.5
#: What a text without a letter is.
UNKNOWN = "und"
#: Bytes of texts handled at once, characters of a piece of them, and matrix values gathered at once.
BATCH, PIECE, GATHERED = 1 << 20, 1 << 18, 1 << 21
#: Languages whose counts a task holds before it hands them on, and the driver fetches at once.
HELD = 16

_LETTER = regex.compile(r"\p{L}")
_BLANKS = regex.compile(r"[^\p{L}\p{M}]+")


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def letters(text: str) -> str:
    """Words of lower-case letters between single blanks, composed, with a blank at both ends."""
    return " " + _BLANKS.sub(" ", unicodedata.normalize("NFC", text.lower())).strip(" ") + " "


def buckets(codes: np.ndarray, owner: np.ndarray, order: int, n: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of one order within one text, and whose they are.

    ``codes`` are characters of texts put one after the other, ``owner`` the
    ascending number of the text of each. Blanks alone are no n-gram.
    """
    if len(codes) < order:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last = len(codes) - order + 1
    hashed = np.full(last, order, dtype=np.uint64)
    for k in range(order):
        hashed = (hashed ^ codes[k : last + k]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    inside = owner[:last] == owner[order - 1 :]
    if order == 1:
        inside &= codes != 32
    return (hashed[inside] % np.uint64(n)).astype(np.int64), owner[:last][inside]


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Characters of all texts with letters, their owners, and how many of them n-grams may start at.

    Short texts are put together; a long one is cut into windows of PIECE
    characters, each with the few characters that its last n-grams reach into.
    """

    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)

    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        if not has_letter(text):
            continue
        clean = letters(text)
        if len(clean) > PIECE:
            for start in range(0, len(clean), PIECE):
                window = codes(clean[start : start + PIECE + max(ORDERS) - 1])
                yield window, np.full(len(window), i, dtype=np.int64), min(PIECE, len(clean) - start)
            continue
        held.append(codes(clean))
        owners.append(np.full(len(clean), i, dtype=np.int64))
        size += len(clean)
        if size >= PIECE:
            yield np.concatenate(held), np.concatenate(owners), size
            held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners), size


def grams(texts: list[str | None], n: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and owners of all n-grams of all texts, in parts; owners ascend within a part."""
    for codes, owner, starts in pieces(texts):
        for order in ORDERS:
            yield buckets(codes[: starts + order - 1], owner[: starts + order - 1], order, n)


@dataclass
class Model:
    """``weights`` are the log-probabilities by bucket and language, ``prior`` those of the languages."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text, and its probability; ``und`` and 0 without a letter."""
        n = len(self.languages)
        totals = np.tile(self.prior, (len(texts), 1))
        if n:
            step = max(1, GATHERED // n)
            for found, owner in grams(texts, len(self.weights)):
                for start in range(0, len(found), step):
                    part, whose = found[start : start + step], owner[start : start + step]
                    firsts = np.concatenate([[0], np.flatnonzero(whose[1:] != whose[:-1]) + 1])
                    totals[whose[firsts]] += np.add.reduceat(self.weights[part], firsts, axis=0, dtype=np.float64)
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not n or not has_letter(text):
                names.append(UNKNOWN)
                continue
            best = int(totals[i].argmax())
            names.append(self.languages[best])
            scores[i] = 1 / np.exp(totals[i] - totals[i, best]).sum()
        return names, scores


def count(docs: DataFrame, n: int = BUCKETS) -> DataFrame:
    """N-grams of all documents with a language and a letter: ``(lang, bucket, n)``; bucket -1 counts the documents.

    A task adds up what it reads, a few languages at a time, so a frequent
    language is no hot key.
    """
    reach_workers(docs.sparkSession)

    def rows(sums: dict[str, np.ndarray], seen: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(counts[at], seen[lang]), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for start, stop in slices(batch.column("text"), BATCH):
                part = batch.slice(start, stop - start)
                texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
                for lang in sorted(set(langs)):
                    own = [t for t, x in zip(texts, langs, strict=True) if x == lang and has_letter(t)]
                    if not own:
                        continue
                    if lang not in sums and len(sums) == HELD:
                        yield from rows(sums, seen)
                        sums, seen = {}, {}
                    total = sums.setdefault(lang, np.zeros(n, dtype=np.int64))
                    for found, _ in grams(own, n):
                        total += np.bincount(found, minlength=n)
                    seen[lang] = seen.get(lang, 0) + len(own)
        yield from rows(sums, seen)

    counted = docs.filter("lang is not null and text is not null").select("lang", "text").mapInArrow(add_up, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train: Column, n: int = BUCKETS) -> Model:
    """A model of all documents with text and language where ``train`` holds.

    The counts come to the driver: at most ``n`` numbers for each of
    ``LANGUAGES`` languages, however large the corpus; more languages are
    refused. Without documents the model knows no language.
    """
    shared_dir(docs.sparkSession)
    counted = count(docs.filter(train), n).checkpoint()
    languages = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").limit(LANGUAGES + 1).collect()]
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    counts, documents = np.zeros((n, len(languages))), np.zeros(len(languages))
    places = {lang: i for i, lang in enumerate(languages)}
    for start in range(0, len(languages), HELD):
        found = counted.filter(F.col("lang").isin(languages[start : start + HELD])).toArrow()
        of = np.array([places[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
        bucket, times = found.column("bucket").to_numpy(), found.column("n").to_numpy()
        counts[bucket[bucket >= 0], of[bucket >= 0]] = times[bucket >= 0]
        documents[of[bucket < 0]] = times[bucket < 0]
    smooth = counts + SMOOTHING
    prior = np.log(documents / documents.sum()) if len(languages) else documents
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every whole text judged: ``(doc_id, lang_pred, score)``.

    Texts that are null, empty or without a letter are ``und`` with a score of
    0, as are all if the model knows no language. Repeated rows are judged
    alike, among equally likely languages the first by name wins; an empty
    table gives no rows; other columns are not looked at. Nothing is shuffled.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    held = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), BATCH):
                part = batch.slice(start, stop - start)
                names, scores = held.value.judge(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")
