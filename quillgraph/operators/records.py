"""Unigram counts of articles, made inside the record where an id has only one."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.functions.utf8 import strict_words
from quillgraph.sources.shared import reach_workers

# Words whose document frequency is broadcast, and the bytes that one may have.
LISTED_WORDS = 500_000
LISTED_BYTES = 64
# Words that a task counts before it hands them on.
COUNTED_WORDS = 200_000


@dataclass
class Records:
    """Article records with a text, how many there are, and if each has an id of its own."""

    rows: DataFrame
    n: int
    unique: bool


def records(articles: DataFrame, without_id: bool = False) -> Records:
    """The records that count, and from their ids whether any has several. Those ``without_id`` share the null one."""
    known = articles.filter("text <> ''" if without_id else "text <> '' and doc_id is not null")
    found = known.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    return Records(known, found.n or 0, (found.most or 0) <= 1)


def own_counts(known: DataFrame, compat: bool = False) -> DataFrame:
    """Term counts of records with ids of their own: ``(doc_id, unigram, n, max_n)``, with ``compat`` ``lax`` too.

    The unigrams of a record are sorted where it lies and equal neighbours
    counted, so nothing is shuffled and no hash table holds more than one
    record. ``max_n`` is the greatest count of the record under the rule that
    TF goes by. With ``compat`` a unigram is followed by one blank, a lax one
    by two: no unigram holds a blank, so both stand side by side.
    """
    strict = F.array_remove(tx.unigrams(F.col("text")), "")
    if compat:
        lax = F.array_remove(tx.unigrams(F.col("text"), compat=True), "")
        strict = F.concat(F.transform(strict, lambda x: F.concat(x, F.lit(" "))), F.transform(lax, lambda x: F.concat(x, F.lit("  "))))
    words = known.select("doc_id", F.sort_array(strict).alias("words"))
    last = F.size("words") - 1
    new = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get("words", i - 1) != F.get("words", i)))
    starts = words.select("doc_id", "words", F.when(last >= 0, new).alias("starts"))
    length = F.transform("starts", lambda start, i: (F.coalesce(F.get("starts", i + 1), F.size("words")) - start).cast("bigint"))
    # Of sorted words the distinct ones stand in the order of the runs.
    cut = starts.select("doc_id", F.array_distinct("words").alias("unigram"), length.alias("n"))
    runs = F.arrays_zip("unigram", "n").alias("runs")
    if not compat:
        return _rows(cut.select("doc_id", F.array_max("n").alias("max_n"), runs), "runs").select("doc_id", "unigram", "n", "max_n")
    runs = cut.select("doc_id", runs)
    peak = F.array_max(F.transform("runs", lambda x: F.when(x["unigram"].endswith("  "), x["n"])))

    def pair(x: Column, i: Column) -> Column:
        # What stands behind a strict run may be the lax run of the same unigram, which then gives no row of its own.
        after, before = F.get("runs", i + 1), F.get("runs", i - 1)
        lax_too = F.coalesce(after["unigram"] == F.concat(x["unigram"], F.lit(" ")), F.lit(False))
        strict_too = F.coalesce((i > 0) & (x["unigram"] == F.concat(before["unigram"], F.lit(" "))), F.lit(False))
        none, n = F.lit(0).cast("bigint"), x["n"]
        lone = x["unigram"].endswith("  ")
        return F.when(~(lone & strict_too), F.struct(
            F.rtrim(x["unigram"], F.lit(" ")).alias("unigram"),
            F.when(lone, none).otherwise(n).alias("n"),
            F.when(lone, n).when(lax_too, after["n"]).otherwise(none).alias("lax"),
        ))

    pairs = F.array_compact(F.transform("runs", pair))
    met = runs.select("doc_id", peak.alias("max_n"), pairs.alias("pairs"))
    return _rows(met, "pairs").select("doc_id", "unigram", "n", "lax", "max_n")


def _rows(held: DataFrame, terms: str) -> DataFrame:
    # Not a plain inline: Spark would push a test that the array is not empty down to the scan, and make the array there once more.
    return held.select("doc_id", "max_n", F.inline_outer(terms)).filter("unigram is not null")


def own_terms(known: DataFrame) -> DataFrame:
    """The distinct unigrams of records with ids of their own: ``(doc_id, unigram)``."""
    return known.select("doc_id", F.explode_outer(F.array_distinct(tx.unigrams(F.col("text")))).alias("unigram")).filter("unigram <> ''")


def own_doc_freq(known: DataFrame) -> DataFrame:
    """Number of records per unigram, where ids are unique: ``(unigram, df)``.

    Words are counted over many records before they are shuffled, up to
    ``COUNTED_WORDS`` distinct ones at a time.
    """
    reach_workers(known.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update({*strict_words(text.as_py())})
                if len(found) > COUNTED_WORDS:
                    yield _counted(found)
                    found.clear()
        yield _counted(found)

    counted = known.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "unigram binary, df bigint")
    return counted.groupBy(F.col("unigram").cast("string").alias("unigram")).agg(F.sum("df").alias("df"))


def _counted(found: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"unigram": pa.array(found.keys(), pa.binary()), "df": pa.array(found.values(), pa.int64())})


@dataclass
class Frequencies:
    """The document frequency of each unigram, parted into a bounded list of frequent words and the rest.

    ``spread`` has one row ``(unigram, df)`` per unigram, frozen, of ``n_docs``
    records. Listed are the most frequent words, at most ``LISTED_WORDS`` of at
    most ``LISTED_BYTES`` bytes: those above the smallest power of two that
    leaves so few. ``rest_is_lone`` says that all others are in one document only.
    """

    spread: DataFrame
    n_docs: int
    on_list: Column
    rest_is_lone: bool

    def listed(self) -> DataFrame:
        return self.spread.filter(self.on_list)

    def rest(self) -> DataFrame:
        return self.spread.filter(~self.on_list)

    def idf(self, df: Column) -> Column:
        return F.log10(F.lit(self.n_docs).cast("bigint") / df)


def frequencies(spread: DataFrame, n_docs: int, listed_words: int | None = None) -> Frequencies:
    """The frequencies of ``spread``, which is frozen, with their list of at most ``listed_words``."""
    most = LISTED_WORDS if listed_words is None else listed_words
    # An unusual word may be long; a listed one is not, so the list is bounded in bytes too.
    short = F.octet_length("unigram") <= LISTED_BYTES
    over = spread.agg(*[F.count_if(short & (F.col("df") > 2**i)).alias(f"p{i}") for i in range(63)]).first()
    floor = 2 ** next(i for i in range(63) if over[i] <= most)
    on_list = short & (F.col("df") > floor)
    lone = (spread.filter(~on_list).agg(F.max("df")).first()[0] or 1) == 1
    return Frequencies(spread, n_docs, on_list, lone)


def with_doc_freq(pairs: DataFrame, found: Frequencies) -> DataFrame:
    """``pairs`` with the ``df`` of their unigram, null where ``n`` is 0.

    The listed words are broadcast. Where all others are in one document
    only, a word that is not on the list has a frequency of 1; else the pairs
    of the others meet theirs in a shuffle, which holds no frequent word.
    """
    met = pairs.join(F.broadcast(found.listed()), "unigram", "left")
    if found.rest_is_lone:
        return met.withColumn("df", F.when(F.col("n") > 0, F.coalesce("df", F.lit(1).cast("bigint"))))
    near = met.filter("df is not null or n = 0")
    far = met.filter("df is null and n > 0").drop("df").join(found.rest(), "unigram")
    return near.unionByName(far)
