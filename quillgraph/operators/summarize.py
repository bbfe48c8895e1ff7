"""Extractive summaries: score the sentences of an article, keep the best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators.scoring import Chosen, Cut, Scores, note_of, noted, scored_in_record
from quillgraph.operators.tfidf import tf_idf
from quillgraph.sources.shared import shared_dir


# Bytes of a text that its fixed-width key holds.
KEY_BYTES = 7
# Hashes of repeating ids that are broadcast, 8 bytes each.
BROADCAST_IDS = 1_000_000


def text_key(text: Column) -> Column:
    """The first bytes of a text as a number that orders like them, a shorter text before a longer one or level with it."""
    head = F.substring(text.cast("binary"), 1, KEY_BYTES)
    return F.conv(F.rpad(F.hex(head), 2 * KEY_BYTES, "0"), 16, 10).cast("bigint")


def one_article(articles: DataFrame) -> DataFrame:
    """One text per document id: ``(doc_id, text)``.

    Where an id has several records the greatest text is taken, a fixed choice
    for an order the rule leaves open. Which ids repeat is counted first, from
    the ids alone; the text of an id that does not is neither shuffled nor
    sorted. Of the others a hash aggregate finds each id's greatest fixed-width
    key and the records with that key are fetched; those that tie are cut to
    one per task before they are compared. From here on a document is no
    larger than one record.

    Repeating ids travel as 64-bit hashes, by broadcast if they are at most
    ``BROADCAST_IDS``, by a shuffle join beyond. A collision only sends one id
    more through the choice. Records without an id are left out, as the joins
    that follow would.
    """
    shared_dir(articles.sparkSession)
    kept = articles.filter("text <> '' and doc_id is not null").select("doc_id", "text")
    ids = articles.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = ids.filter("n > 1").select(F.xxhash64("doc_id").alias("_hash")).checkpoint()
    n = repeated.count()
    if n == 0:
        return noted(kept, Chosen(articles))
    if n <= BROADCAST_IDS:
        repeated = F.broadcast(repeated)
    hashed = kept.withColumn("_hash", F.xxhash64("doc_id"))
    several = hashed.join(repeated, "_hash", "left_semi").withColumn("_key", text_key(F.col("text")))
    greatest = several.groupBy("doc_id").agg(F.max("_key").alias("_key"))
    tied = several.join(greatest, ["doc_id", "_key"], "left_semi")
    last_first = Window.partitionBy("doc_id").orderBy(F.desc("text"))
    chosen = tied.withColumn("_row", F.row_number().over(last_first)).filter("_row = 1").select("doc_id", "text")
    return noted(hashed.join(repeated, "_hash", "left_anti").select("doc_id", "text").unionByName(chosen), Chosen(None))


def split_sentences(articles: DataFrame) -> DataFrame:
    """Sentences by position: ``(doc_id, pos, sentence)``."""
    # Not a plain posexplode: Spark would push a test that there are sentences down to the scan, and cut the text there once more.
    pieces = F.posexplode_outer(tx.sentences(F.col("text"))).alias("pos", "sentence")
    return noted(articles.select("doc_id", pieces).filter("pos is not null"), Cut(articles))


def score_sentences(sentences: DataFrame, weights: DataFrame, n: int = 5) -> DataFrame:
    """Sum of the ``n`` best distinct words of each sentence: ``(doc_id, pos, score)``.

    Words tied with the n-th best all count. A sentence without a weighted
    word scores 0. Values are added from the largest down, so equal word
    weights give equal scores on every run.

    Sentences of articles with ids of their own, as :func:`split_sentences`
    gave them, are scored in the record, by the same rule: their words are not
    shuffled. The TF·IDF of the same articles is made there too; other weights
    are shuffled once, packed by document.
    """
    own = scored_in_record(sentences, weights, n)
    if own is not None:
        return own
    # A sentence without words keeps one row, with a null word.
    distinct = F.array_remove(F.array_distinct(tx.unigrams(F.col("sentence"))), "")
    words = sentences.select("doc_id", "pos", F.explode_outer(distinct).alias("unigram"))
    weighted = words.join(weights, ["doc_id", "unigram"], "left").select("doc_id", "pos", "tfidf")
    # The cut is a group limit over the words as they are, so a sentence of any
    # length is streamed, not collected or hashed; only what it leaves is counted.
    down = Window.partitionBy("doc_id", "pos").orderBy(F.desc("tfidf"))
    # Shuffled before the cut: a sentence's words are scattered here, so cutting per task would sort them for nothing.
    dealt = weighted.repartition("doc_id", "pos")
    kept = dealt.withColumn("_place", F.rank().over(down)).filter(F.col("_place") <= n)
    kept = kept.groupBy("doc_id", "pos", "tfidf").agg(F.count("tfidf").alias("times"))
    best = kept.groupBy("doc_id", "pos").agg(
        F.sort_array(F.collect_list(F.struct("tfidf", F.col("times").cast("int").alias("times"))), asc=False).alias("best")
    )
    total = F.aggregate(
        "best",
        F.lit(0.0),
        lambda sum_, x: F.aggregate(F.array_repeat(x["tfidf"], x["times"]), sum_, lambda t, value: t + value),
    )
    return best.select("doc_id", "pos", total.alias("score"))


def attach_scores(sentences: DataFrame, scores: DataFrame) -> DataFrame:
    """Sentences with their score, 0 where there is none: ``(doc_id, pos, sentence, score)``.

    Scores made in the record of the same sentences are made beside them.
    """
    own = note_of(scores, Scores)
    if own is not None and own.sentences is sentences:
        return own.rows(True)
    joined = sentences.join(scores, ["doc_id", "pos"], "left")
    return joined.select("doc_id", "pos", "sentence", F.coalesce("score", F.lit(0.0)).alias("score"))


def top_sentences(scored: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` best rows of each document; equal scores go to the earlier one."""
    best_first = Window.partitionBy("doc_id").orderBy(F.desc("score"), "pos")
    return scored.withColumn("_row", F.row_number().over(best_first)).filter(F.col("_row") <= k).drop("_row")


def summarize(
    articles: DataFrame,
    weights: DataFrame | None = None,
    k: int = 3,
    n: int = 5,
    compat: bool = False,
) -> DataFrame:
    """Best ``k`` sentences of each document in reading order: ``(doc_id, summary)``.

    Without ``weights`` they are computed from the articles. Given weights may
    name documents that have no article; those get the summary of one empty
    sentence.

    Each id has one text here, so sentences are scored where they lie; of each
    document only the best, cut per task first, are shuffled.
    """
    if weights is None:
        weights = tf_idf(articles, compat=compat)
        corpus = one_article(articles)
    else:
        shared_dir(articles.sparkSession)
        known = one_article(articles)
        named = weights.filter("doc_id is not null").select("doc_id").distinct()
        bare = named.join(known.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit("").alias("text")).checkpoint()
        corpus = noted(known.unionByName(bare), Chosen(None))

    sentences = split_sentences(corpus)
    best = top_sentences(attach_scores(sentences, score_sentences(sentences, weights, n)), k)
    chosen = best.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "sentence"))).alias("best"))
    parts = F.transform("best", lambda x: F.concat(x["sentence"], F.lit(". ")))
    return corpus.select("doc_id").join(chosen, "doc_id", "left").select(
        "doc_id", F.coalesce(F.concat_ws("", parts), F.lit("")).alias("summary")
    )
