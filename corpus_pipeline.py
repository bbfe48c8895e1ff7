"""The training-data pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``. Rows of an empty table stay none; null texts
count as empty in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.llm import mixing, ngramjoin, suffixdedup, toxicity, wordbpe
from quillgraph.llm.common import spare_memory, table
from quillgraph.sources.shared import work_folder

#: Text models and exact substring search are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores 0.5 or more go. It learns from all labels of documents at hand."""
    spare_memory(spark)
    known = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.reject(docs, known, 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the smallest id stays."""
    spare_memory(spark)
    return ngramjoin.one_of_each(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words and byte strings of 400 that also start elsewhere are cut out, characters cut in half with them.

    Texts of which nothing is left go; ``n_chars``, if there, is counted anew.
    """
    spare_memory(spark)
    return suffixdedup.without_repeats(docs, length=400, words=51)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document: whole copies, and its first words where it is taken in part.

    The mix takes a source's documents one after the other, over and over, so
    it takes part of one document a source at most. Rows of one id, source and
    number of words are taken in the order of their texts' hashes. What the
    mix takes no word of, such as documents without words, goes; ``n_chars``,
    if there, is counted anew for a part.
    """
    spare_memory(spark)
    spare = "_mix"
    while any(c.lower().startswith(spare) for c in docs.columns):
        spare = "_" + spare
    key, n, nth, whole, part, copy = (f"{spare}_{x}" for x in ("key", "n", "nth", "whole", "part", "copy"))
    taken, all_, cut, times = f"{spare}_taken", f"{spare}_all", f"{spare}_cut", f"{spare}_times"
    named = lambda size: F.xxhash64("doc_id", F.isnull("doc_id"), "source", F.isnull("source"), size)
    sums = mixing.mix(docs).select(named("size").alias(key), "size", "taken").groupBy(key).agg(F.sum("taken").alias(taken), F.sum("size").alias(all_))
    sized = docs.withColumn(n, mixing.n_words(F.col("text"))).withColumn(key, named(n))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("text"))) - 1
    met = sized.join(sums.filter(F.col(taken) > 0), key).withColumn(nth, place).withColumn(whole, F.expr(f"{taken} div {all_}"))
    rest = F.greatest(F.least(F.col(taken) % F.col(all_) - F.col(nth) * F.col(n), F.col(n)), F.lit(0))
    met = met.withColumn(part, rest.cast("int")).withColumn(times, F.col(whole) + (F.col(part) > 0).cast("long")).filter(F.col(times) > 0)
    met = met.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    met = met.withColumn(cut, (F.col(copy) > F.col(whole)) & (F.col(part) < F.col(n)))
    met = met.withColumn("text", F.when(F.col(cut), mixing.first_words(F.col("text"), F.col(part))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        met = met.withColumn("n_chars", F.when(F.col(cut), counted).otherwise(F.col("n_chars")))
    return met.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    spare_memory(spark)
    file = public_tokenizers.path("byte_bpe_50k.json")
    decoded = wordbpe.decode(wordbpe.encode(docs, file), file)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; the folder goes when the last has ended."""
    docs = table(spark, sf_dir, "documents")
    with work_folder(spark) as work:
        for name, stage in STAGES[:-1]:
            path = work.at(name)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        return work.keep(STAGES[-1][1](spark, docs, sf_dir))
