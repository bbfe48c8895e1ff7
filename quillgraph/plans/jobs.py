"""The batch programs end to end: text files in, text files or ranked lines out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import quillgraph as qg


def word_count(spark: SparkSession, lines: str, out: str) -> None:
    """Word counts of text files as a tab-separated table."""
    qg.write_tsv(qg.word_count(qg.read_lines(spark, lines)), out)


def profile(spark: SparkSession, kind: int, articles: str, out: str, keep_empty: bool = False) -> None:
    """One of the three unigram profiles: vocabulary (1), per article (2), corpus (3)."""
    build, order = {
        1: (qg.vocabulary, ["unigram"]),
        2: (qg.doc_profile, ["doc_id", F.desc("n"), "unigram"]),
        3: (qg.corpus_profile, [F.desc("n"), "unigram"]),
    }[kind]
    qg.write_tsv(build(_articles(spark, articles), keep_empty=keep_empty), out, order_by=order)


def weights(
    spark: SparkSession, articles: str, tf_out: str, idf_out: str, weights_out: str, compat: bool = False
) -> None:
    """TF, IDF and their product as three tab-separated tables.

    The product is made from the two tables as written, so the text is not
    read a third time and a lost executor costs no tokenising.
    """
    corpus = _articles(spark, articles)
    tf = qg.term_freq(qg.tokenize(corpus, compat=compat)).select("doc_id", "unigram", "tf")
    qg.write_tsv(tf, tf_out)
    qg.write_tsv(qg.article_idf(corpus), idf_out)
    merged = qg.combine_weights(
        qg.read_weights(spark, tf_out, name="tf"), qg.read_weights(spark, idf_out, name="idf")
    )
    qg.write_tsv(merged, weights_out)


def summaries(spark: SparkSession, weights: str, articles: str, out: str) -> None:
    """Summaries from a weight table and the articles."""
    terms = qg.read_weights(spark, weights, name="tfidf")
    qg.write_summaries(qg.summarize(_articles(spark, articles), terms), out)


def ranked_pages(
    spark: SparkSession, links: str, titles: str, tax: float | None = None, k: int | None = 10, compat: bool = False
) -> DataFrame:
    """The best pages of a link file by PageRank, all if ``k`` is None, as lines ``rank - title``."""
    edges = qg.parse_links(qg.read_lines(spark, links))
    pages = qg.number_lines(qg.read_lines(spark, titles))
    return qg.format_ranked(qg.top_pages(qg.pagerank(edges, tax=tax), pages, k, compat))


def bombed_pages(
    spark: SparkSession,
    links: str,
    titles: str,
    keyword: str,
    target: str,
    copies: int = 5,
    k: int = 10,
    every_page: bool = False,
) -> DataFrame:
    """The best pages for a keyword once the links to the target are in place.

    Ranks the target among the pages with the keyword in their title, or among
    all pages reached with ``every_page``.
    """
    edges = qg.parse_links(qg.read_lines(spark, links), dedupe=False)
    pages = qg.number_lines(qg.read_lines(spark, titles))
    ranks = qg.link_bomb(edges, pages, keyword, target, copies)
    listed = pages if every_page else qg.bomb_pages(pages, keyword, target)
    return qg.format_ranked(qg.top_pages(ranks, listed, k))


def _articles(spark: SparkSession, path: str) -> DataFrame:
    return qg.parse_articles(qg.read_lines(spark, path))
