"""Tokenising and the unigram profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as tx
from quillgraph.operators.records import own_counts, records


def tokenize(
    df: DataFrame,
    col: str = "text",
    keys: tuple[str, ...] = ("doc_id",),
    compat: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """One row ``(*keys, unigram)`` per token of ``col``.

    ``keep_empty`` also keeps the tokens that normalise to nothing.
    """
    if keep_empty:
        raw = df.select(*keys, F.explode(tx.raw_tokens(F.col(col))).alias("_token")).filter("_token <> ''")
        return raw.select(*keys, tx.normalize(F.col("_token"), compat).alias("unigram"))
    # Not a plain explode: Spark would push a test that there are tokens down to the scan, and split the text there once more.
    return df.select(*keys, F.explode_outer(tx.unigrams(F.col(col), compat)).alias("unigram")).filter("unigram <> ''")


def tokenize_raw(df: DataFrame, col: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row ``(*keys, word)`` per piece of a line between single spaces.

    Runs of spaces give empty words; those at the end of a line do not.
    """
    return df.select(*keys, F.explode(tx.split_char(F.col(col), " ")).alias("word"))


def explode_lines(df: DataFrame, col: str = "text") -> DataFrame:
    """The lines of a multi-line column as rows ``(value)``."""
    return df.select(F.explode(tx.text_lines(F.col(col))).alias("value"))


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Occurrences of each raw word: ``(word, n)``."""
    return tokenize_raw(lines, col).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(articles: DataFrame, limit: int | None = None, keep_empty: bool = False) -> DataFrame:
    """Distinct unigrams of the corpus in byte order: ``(unigram)``."""
    words = tokenize(articles, keys=(), keep_empty=keep_empty).distinct().orderBy("unigram")
    return words if limit is None else words.limit(limit)


def doc_profile(articles: DataFrame, limit: int | None = None, keep_empty: bool = False) -> DataFrame:
    """Unigram counts per article, most frequent first: ``(doc_id, unigram, n)``.

    The sort key ends with the unigram, so a range partition can cut through
    the terms of one large article.
    """
    counts = term_counts(tokenize(articles, keep_empty=True)) if keep_empty else article_counts(articles)
    ranked = counts.orderBy("doc_id", F.desc("n"), "unigram")
    return ranked if limit is None else ranked.limit(limit)


def corpus_profile(articles: DataFrame, limit: int | None = None, keep_empty: bool = False) -> DataFrame:
    """Unigram counts of the corpus, most frequent first: ``(unigram, n)``."""
    counts = tokenize(articles, keys=(), keep_empty=keep_empty).groupBy("unigram").agg(F.count("*").alias("n"))
    ranked = counts.orderBy(F.desc("n"), "unigram")
    return ranked if limit is None else ranked.limit(limit)


def term_counts(tokens: DataFrame) -> DataFrame:
    """Raw frequency of each unigram in each document: ``(doc_id, unigram, n)``."""
    return tokens.groupBy("doc_id", "unigram").agg(F.count("*").alias("n"))


def article_counts(articles: DataFrame) -> DataFrame:
    """As :func:`term_counts` over the unigrams of articles, counted in the record where ids are unique."""
    found = records(articles, without_id=True)
    return own_counts(found.rows).drop("max_n") if found.unique else term_counts(tokenize(articles))
