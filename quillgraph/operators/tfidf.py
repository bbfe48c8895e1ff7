"""Term frequency, inverse document frequency and their product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators.profiles import term_counts, tokenize
from quillgraph.operators.records import (
    Frequencies,
    Records,
    frequencies,
    own_counts,
    own_doc_freq,
    own_terms,
    records,
    with_doc_freq,
)
from quillgraph.operators.scoring import OwnWeights, noted
from quillgraph.operators.skew import salted_join
from quillgraph.sources.shared import shared_dir

# What no unigram holds: a blank before a lax token, and the row that stands for a record.
LAX = " "
RECORD = "  "


def augmented_tf(n: Column, max_n: Column) -> Column:
    return F.lit(0.5) + F.lit(0.5) * (n / max_n)


def term_freq(tokens: DataFrame, **skew) -> DataFrame:
    """Augmented term frequency: ``(doc_id, unigram, n, tf)``."""
    return _with_tf(_counts(tokens), skew).select("doc_id", "unigram", "n", "tf")


def article_tf(articles: DataFrame, compat: bool = False, **skew) -> DataFrame:
    """As :func:`term_freq` over the unigrams of articles, counted in the record where ids are unique."""
    found = records(articles)
    if not found.unique:
        return term_freq(tokenize(articles, compat=compat), **skew)
    n = F.col("lax" if compat else "n")
    counts = own_counts(found.rows, compat).filter(n > 0)
    return counts.select("doc_id", "unigram", n.alias("n"), augmented_tf(n, F.col("max_n")).alias("tf"))


def doc_freq(tokens: DataFrame) -> DataFrame:
    """Number of distinct documents per unigram: ``(unigram, df)``."""
    pairs = tokens.select("doc_id", "unigram").distinct()
    return pairs.groupBy("unigram").agg(F.count("*").alias("df"))


def corpus_size(articles: DataFrame) -> DataFrame:
    """Number of article records with an id and a text, as one row ``(n_docs)``."""
    return articles.filter("text <> '' and doc_id is not null").agg(F.count("*").alias("n_docs"))


def idf(tokens: DataFrame, articles: DataFrame, **skew) -> DataFrame:
    """Inverse document frequency per document and unigram: ``(doc_id, unigram, idf)``.

    Tokens and articles are two inputs here; :func:`article_idf` reads the
    articles once for both.
    """
    counts = _counts(tokens)
    n_docs = corpus_size(articles).scalar()
    return _with_idf(counts, counts, n_docs, skew).select("doc_id", "unigram", "idf")


def article_idf(articles: DataFrame, **skew) -> DataFrame:
    """As :func:`idf` over the strict unigrams, from one pass over the articles."""
    found = records(articles)
    if found.unique:
        terms = own_terms(found.rows).withColumn("n", F.lit(1))
        return _own_idf(terms, _frozen_freq(found, skew)).select("doc_id", "unigram", "idf")
    counts, n_docs = _counted(articles)
    return _with_idf(counts, counts, n_docs, skew).select("doc_id", "unigram", "idf")


def combine_weights(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """Multiply both weights; a missing side counts as 1: ``(doc_id, unigram, tfidf)``."""
    product = F.coalesce(F.col("tf"), F.lit(1.0)) * F.coalesce(F.col("idf"), F.lit(1.0))
    left = tf.select("doc_id", "unigram", "tf")
    right = idf.select("doc_id", "unigram", "idf")
    return left.join(right, ["doc_id", "unigram"], "full").select("doc_id", "unigram", product.alias("tfidf"))


def tf_idf(articles: DataFrame, compat: bool = False, **skew) -> DataFrame:
    """TF·IDF of each unigram in each document: ``(doc_id, unigram, tfidf)``.

    Both weights come from the same counts, and so does the number of
    records, so the text is read and shuffled once. ``compat`` uses the lax
    normaliser for TF only: a pair is then counted under both rules, and a
    weight whose rule does not know the pair is 1, as in
    :func:`combine_weights`.

    Where no id has two records, terms are counted in the record and the
    frequent words meet their document frequency by broadcast, so that only
    the frequencies and rare words are shuffled; the text is then read once
    for the frequencies and once or twice for the weights. ``score_sentences``
    knows these weights and makes them where the sentences are.
    """
    rule = "lax" if compat else "n"
    tf = F.when(F.col(rule) > 0, F.col("tf")).otherwise(1.0)
    idf_ = F.when(F.col("n") > 0, F.col("idf")).otherwise(1.0)
    product = (tf * idf_).alias("tfidf")
    found = records(articles)
    if not found.unique:
        counts, n_docs = _counted(articles, compat)
        return _with_idf(_with_tf(counts, skew, rule), counts, n_docs, skew).select("doc_id", "unigram", product)
    counts, freq = own_counts(found.rows, compat), _frozen_freq(found, skew)
    weighted = _own_idf(counts.withColumn("tf", augmented_tf(F.col(rule), F.col("max_n"))), freq)
    return noted(weighted.select("doc_id", "unigram", product), OwnWeights(articles, freq, compat))


def _frozen_freq(found: Records, skew: dict) -> Frequencies:
    shared_dir(found.rows.sparkSession)
    return frequencies(own_doc_freq(found.rows).checkpoint(), found.n, skew.get("hot_keys"))


def _own_idf(pairs: DataFrame, freq: Frequencies) -> DataFrame:
    return with_doc_freq(pairs, freq).withColumn("idf", freq.idf(F.col("df"))).drop("df")


def _with_tf(counts: DataFrame, skew: dict, rule: str = "n") -> DataFrame:
    # The maximum is a small aggregate joined back, not a window: a window
    # would put all terms of one document into one task.
    peaks = counts.groupBy("doc_id").agg(
        F.nullif(F.max(rule), F.lit(0)).alias("max_n"), F.when(F.max("n") >= 0, F.count("*")).alias("terms")
    )
    joined = salted_join(counts, peaks, "doc_id", "unigram", "terms", **skew)
    return joined.withColumn("tf", augmented_tf(F.col(rule), F.col("max_n"))).drop("max_n", "terms")


def _with_idf(pairs: DataFrame, counts: DataFrame, n_docs: Column, skew: dict) -> DataFrame:
    rows = F.when(F.max("n") >= 0, F.count("*")).alias("rows")
    spread = counts.groupBy("unigram").agg(F.nullif(F.count_if(F.col("n") > 0), F.lit(0)).alias("df"), rows)
    joined = salted_join(pairs, spread, "unigram", "doc_id", "rows", **skew)
    return joined.withColumn("idf", F.log10(n_docs / F.col("df"))).drop("df", "rows")


def _counts(tokens: DataFrame) -> DataFrame:
    """Term counts whose one shuffle serves all uses below.

    Spark reuses a shuffle only where both plans below it are the same. So the
    key is filtered here as the joins would filter it, and each aggregate on
    the counts reads the frequency, also where a bare row count would do: were
    ``n`` pruned from one of them, the text would be tokenised once more.
    """
    return term_counts(tokens.filter("doc_id is not null"))


def _counted(articles: DataFrame, compat: bool = False) -> tuple[DataFrame, Column]:
    """Term counts and the number of records from one pass over the text.

    Each record adds one row of its own to its tokens, under a unigram that no
    token has, so records without a token are counted too. These rows count
    downwards: only the sign of a sum tells them from tokens, which is known
    behind the shuffle alone, so the filter stays there and both results read
    the same shuffle. With ``compat`` the lax tokens travel along behind a
    blank, and ``lax`` counts them.
    """
    known = articles.filter("text <> '' and doc_id is not null")
    pieces = tx.unigrams(F.col("text"))
    if compat:
        lax = F.transform(tx.unigrams(F.col("text"), compat=True), lambda token: F.concat(F.lit(LAX), token))
        pieces = F.concat(pieces, lax)
    token = F.col("_token")
    rows = known.select("doc_id", F.explode_outer(F.array_append(pieces, F.lit(RECORD))).alias("_token"))
    rows = rows.filter((token != "") & (token != LAX))
    is_record, is_lax = token == RECORD, token.startswith(LAX) & (token != RECORD)
    unigram = F.when(is_lax, F.substr(token, F.lit(len(LAX) + 1))).otherwise(token)
    strict = F.when(is_record, -1).when(is_lax, 0).otherwise(1).cast("bigint")
    rows = rows.select("doc_id", unigram.alias("unigram"), strict.alias("n"), is_lax.cast("bigint").alias("lax"))
    # Both uses of the counts must filter alike, or they would not share the shuffle.
    rows = rows.filter("unigram is not null")
    sums = [F.sum("n").alias("n"), *([F.sum("lax").alias("lax")] if compat else [])]
    every = rows.groupBy("doc_id", "unigram").agg(*sums)
    n_docs = every.agg((-F.sum(F.least(F.col("n"), F.lit(0)))).alias("n_docs")).scalar()
    return every.filter("n >= 0"), n_docs
