"""The registered queries: every operator on the given tables.

Values are rounded to six places here, and only here, so that two engines
which add in a different order still agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import quillgraph as qg
from quillgraph.functions import text as tx
from quillgraph.plans.oracle import KEYWORD, TARGET
from quillgraph.plans.tables import documents, links, pages, table

Query = Callable[[SparkSession, str], DataFrame]

# How texts are packed that a query writes for itself and that are larger than its input.
PACKED = "gzip"


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


# Words and profiles


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.word_count(qg.explode_lines(documents(spark, sf_dir)))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.vocabulary(documents(spark, sf_dir))


def vocabulary_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.vocabulary(documents(spark, sf_dir), keep_empty=True)


def doc_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.doc_profile(documents(spark, sf_dir))


def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.corpus_profile(documents(spark, sf_dir))


def corpus_profile_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.corpus_profile(documents(spark, sf_dir), limit=500)


def token_normalizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct raw tokens with their strict and lax unigram."""
    raw = documents(spark, sf_dir).select(F.explode(tx.raw_tokens(F.col("text"))).alias("token"))
    token = F.col("token")
    return (
        raw.filter("token <> ''")
        .distinct()
        .select("token", tx.normalize(token).alias("strict"), tx.normalize(token, compat=True).alias("lax"))
    )


# Term weights


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws("<====>", "source", F.col("doc_id").cast("string"), "text")
    return documents(spark, sf_dir).select(line.alias("value"))


def parse_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.parse_articles(article_lines(spark, sf_dir))


def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.corpus_size(documents(spark, sf_dir))


def term_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = qg.article_tf(documents(spark, sf_dir))
    return freq.select("doc_id", "unigram", "n", rounded("tf"))


def term_freq_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = qg.article_tf(documents(spark, sf_dir), compat=True)
    return freq.select("doc_id", "unigram", "n", rounded("tf"))


def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.doc_freq(qg.tokenize(documents(spark, sf_dir)))


def doc_freq_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.article_idf(documents(spark, sf_dir)).select("doc_id", "unigram", rounded("idf"))


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.tf_idf(documents(spark, sf_dir)).select("doc_id", "unigram", rounded("tfidf"))


def tf_idf_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.tf_idf(documents(spark, sf_dir), compat=True).select("doc_id", "unigram", rounded("tfidf"))


def combine_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF with the lax keys merged with IDF with the strict ones, from separate tables."""
    docs = documents(spark, sf_dir)
    tf = qg.article_tf(docs, compat=True)
    idf = qg.article_idf(docs)
    return qg.combine_weights(tf, idf).select("doc_id", "unigram", rounded("tfidf"))


# Summaries


def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.split_sentences(documents(spark, sf_dir))


def _scored(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    sentences = qg.split_sentences(docs)
    return sentences, qg.score_sentences(sentences, qg.tf_idf(docs))


def sentence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scores = _scored(documents(spark, sf_dir))
    return scores.select("doc_id", "pos", rounded("score"))


def attach_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = qg.attach_scores(*_scored(documents(spark, sf_dir)))
    return scored.select("doc_id", "pos", "sentence", rounded("score"))


def top_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = qg.attach_scores(*_scored(documents(spark, sf_dir)))
    return qg.top_sentences(scored).select("doc_id", "pos", "sentence", rounded("score"))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.summarize(documents(spark, sf_dir))


def summaries_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.summarize(documents(spark, sf_dir), compat=True)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of conversations as articles, several under one id: ``(doc_id, text)``."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "text")


def one_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.one_article(turns(spark, sf_dir))


def summaries_several(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries where an id has several articles: weights from all, sentences from one."""
    return qg.summarize(turns(spark, sf_dir))


# Link graph


def link_lines(spark: SparkSession, sf_dir: str, gap: str = " ") -> DataFrame:
    """One link line per line item: the part names its supplier, itself and the supplier again.

    A part meets its suppliers again and again, so lines repeat; what follows a second colon is no link.
    """
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    targets = F.concat(F.lit(" "), supplier, F.lit(gap), part, F.lit(" "), supplier, F.lit("\t"))
    line = F.concat(part, F.lit(":"), targets, F.lit(":"), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select(line.alias("value"))


def _edge_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


def parse_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_counts(qg.parse_links(link_lines(spark, sf_dir)))


def parse_links_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_counts(qg.parse_links(link_lines(spark, sf_dir), dedupe=False))


def parse_links_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link lines with a run of blanks, whose empty target counts as a link to no page."""
    return _edge_counts(qg.parse_links(link_lines(spark, sf_dir, gap="  "), compat=True))


def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.out_degree(links(spark, sf_dir))


def dead_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.dead_ends(links(spark, sf_dir))


def pagerank_ideal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.pagerank(links(spark, sf_dir)).select("page_id", rounded("rank"))


def pagerank_taxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.pagerank(links(spark, sf_dir), tax=0.15).select("page_id", rounded("rank"))


def pagerank_keep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = qg.pagerank(links(spark, sf_dir), tax=0.15, keep_all_pages=True)
    return ranks.select("page_id", rounded("rank"))


def pagerank_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``pagerank_taxed``, with the pages of over 20 links treated as hubs."""
    return qg.pagerank(links(spark, sf_dir), tax=0.15, hot_rows=20).select("page_id", rounded("rank"))


def with_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = qg.pagerank(links(spark, sf_dir), tax=0.15)
    return qg.with_titles(ranks, pages(spark, sf_dir)).select("page_id", "title", rounded("rank"))


def _top(ranks: DataFrame, titles: DataFrame, **options) -> DataFrame:
    return qg.top_pages(ranks, titles, **options).select("page_id", "title", rounded("rank"))


def top_pages_ideal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(qg.pagerank(links(spark, sf_dir)), pages(spark, sf_dir))


def top_pages_taxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(qg.pagerank(links(spark, sf_dir), tax=0.15), pages(spark, sf_dir))


def ranked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with a title, in the order of their ranks."""
    return _top(qg.pagerank(links(spark, sf_dir), tax=0.15), pages(spark, sf_dir), k=None)


def top_pages_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(qg.pagerank(links(spark, sf_dir), tax=0.15), pages(spark, sf_dir), compat=True)


def ranked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.format_ranked(top_pages_taxed(spark, sf_dir))


def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.search_titles(pages(spark, sf_dir), KEYWORD)


def find_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qg.find_page(pages(spark, sf_dir), TARGET)


def keyword_subgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_counts(qg.keyword_subgraph(links(spark, sf_dir), pages(spark, sf_dir), KEYWORD))


def inject_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = qg.find_page(pages(spark, sf_dir), TARGET)
    return _edge_counts(qg.inject_links(links(spark, sf_dir), target))


def inject_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The injected links as a weight on collapsed links."""
    target = qg.find_page(pages(spark, sf_dir), TARGET)
    weighted = qg.inject_weighted(qg.collapse(links(spark, sf_dir)), target)
    return qg.frozen_links(weighted).withColumnRenamed("copies", "n")


def link_bomb(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = qg.link_bomb(links(spark, sf_dir), pages(spark, sf_dir), KEYWORD, TARGET)
    return ranks.select("page_id", rounded("rank"))


def link_bomb_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = pages(spark, sf_dir)
    ranks = qg.link_bomb(links(spark, sf_dir), titles, KEYWORD, TARGET)
    return _top(ranks, qg.bomb_pages(titles, KEYWORD, TARGET))


def link_bomb_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reached pages with a title, in the order of their ranks after the bomb."""
    titles = pages(spark, sf_dir)
    return _top(qg.link_bomb(links(spark, sf_dir), titles, KEYWORD, TARGET), titles, k=None)


def link_bomb_unbought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword sub-graph ranked without any injected link."""
    ranks = qg.link_bomb(links(spark, sf_dir), pages(spark, sf_dir), KEYWORD, TARGET, copies=0)
    return ranks.select("page_id", rounded("rank"))


# Streams and files. What passes through files is frozen before their folder goes.


def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream of the table's own files."""
    with qg.work_folder(spark) as work:
        stream = qg.stream_table(spark, f"{sf_dir}/documents.parquet", "text string")
        state = work.at("state")
        qg.run_word_count(qg.running_word_count(qg.explode_lines(stream)), state)
        return work.keep(qg.read_word_count(spark, state))


def running_word_count_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map after each of two batches: the benchmark's files, then those of the documents, which have arrived since."""
    with qg.work_folder(spark) as work:
        state, out = work.at("state"), work.at("maps")
        for there in ("benchmark", "{benchmark,documents}"):
            stream = qg.stream_table(spark, f"{sf_dir}/{there}.parquet", "text string", batch_bytes=None)
            qg.emit_word_count(qg.running_word_count(qg.explode_lines(stream)), state, out)
        return work.keep(qg.read_emitted(spark, out))


def weights_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF·IDF as a tab-separated text and back."""
    with qg.work_folder(spark) as work:
        path = work.at("weights")
        qg.write_tsv(qg.tf_idf(documents(spark, sf_dir)), path, partitions=20, key=["doc_id"])
        weights = qg.read_weights(spark, path, name="tfidf")
        return work.keep(weights.select(F.col("doc_id").cast("bigint").alias("doc_id"), "unigram", rounded("tfidf")))


def links_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link lines as a text file and back."""
    with qg.work_folder(spark) as work:
        path = work.at("links")
        link_lines(spark, sf_dir).write.text(path)
        return work.keep(_edge_counts(qg.parse_links(qg.read_lines(spark, path))))


def profile_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the corpus profile written as a tab-separated text."""
    with qg.work_folder(spark) as work:
        path = work.at("profile")
        qg.write_tsv(qg.corpus_profile(documents(spark, sf_dir)), path, order_by=[F.desc("n"), "unigram"])
        return work.keep(qg.read_lines(spark, path).withColumnRenamed("value", "line"))


def _numbered_fields(work: qg.WorkFolder, path: str, **kinds: str) -> DataFrame:
    """The lines of a tab-separated text by their number over all part files: ``(line, *kinds)``."""
    lines = qg.number_lines(qg.read_lines(work.spark, path))
    parts = F.split("title", "\t")
    fields = [F.get(parts, F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds.items())]
    return work.keep(lines.select(F.col("page_id").alias("line"), *fields))


def vocabulary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile 1 as a text, each unigram with its line."""
    with qg.work_folder(spark) as work:
        path = work.at("vocabulary")
        qg.write_tsv(qg.vocabulary(documents(spark, sf_dir)), path)
        return _numbered_fields(work, path, unigram="string")


def doc_profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile 2 as a text, each count with its line."""
    with qg.work_folder(spark) as work:
        path = work.at("profile")
        qg.write_tsv(qg.doc_profile(documents(spark, sf_dir)), path, order_by=["doc_id", F.desc("n"), "unigram"])
        return _numbered_fields(work, path, doc_id="bigint", unigram="string", n="bigint")


def corpus_profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile 3 as a text, each count with its line."""
    with qg.work_folder(spark) as work:
        path = work.at("profile")
        qg.write_tsv(qg.corpus_profile(documents(spark, sf_dir)), path, order_by=[F.desc("n"), "unigram"])
        return _numbered_fields(work, path, unigram="string", n="bigint")


def term_freq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term counts spread over twenty part files by ranges of their key, each with its line."""
    with qg.work_folder(spark) as work:
        path = work.at("counts")
        counts = qg.article_counts(documents(spark, sf_dir))
        qg.write_tsv(counts, path, order_by=["doc_id", "unigram"], partitions=20)
        return _numbered_fields(work, path, doc_id="bigint", unigram="string", n="bigint")


def term_freq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term counts spread over twenty part files by the hash of the document.

    For each line the number of files its document is in, and its place
    behind the document's first line there.
    """
    with qg.work_folder(spark) as work:
        path = work.at("counts")
        qg.write_tsv(qg.article_counts(documents(spark, sf_dir)), path, partitions=20, key=["doc_id"], compression=PACKED)
        qg.let_go(spark)
        parts = F.split("value", "\t")
        lines = qg.locate_lines(qg.read_lines(spark, path)).select(
            "file", "line", F.get(parts, F.lit(0)).cast("bigint").alias("doc_id"), F.get(parts, F.lit(1)).alias("unigram")
        )
        homes = lines.groupBy("doc_id", "file").agg(F.min("line").alias("first"))
        homes = homes.groupBy("doc_id").agg(F.min("first").alias("first"), F.count("*").alias("files"))
        placed = lines.join(homes, "doc_id").select("doc_id", "unigram", (F.col("line") - F.col("first")).alias("place"), "files")
        return work.keep(placed)


def summaries_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the summary file with their number of occurrences."""
    with qg.work_folder(spark) as work:
        path = work.at("summaries")
        qg.write_summaries(qg.summarize(documents(spark, sf_dir)), path)
        lines = qg.read_lines(spark, path).withColumnRenamed("value", "line")
        return work.keep(lines.groupBy("line").agg(F.count("*").alias("n")))


def summarize_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries from articles and weights that come from two text files."""
    with qg.work_folder(spark) as work:
        weights_path, articles_path = work.at("weights"), work.at("articles")
        docs = documents(spark, sf_dir)
        # The weights as text are several times as large as the documents.
        qg.write_tsv(qg.tf_idf(docs), weights_path, compression=PACKED)
        flat = F.regexp_replace("text", r"[\r\n]+", " ")
        line = F.concat_ws("<====>", "source", F.col("doc_id").cast("string"), flat)
        docs.select(line.alias("value")).write.text(articles_path, compression=PACKED)
        qg.let_go(spark)
        articles = qg.parse_articles(qg.read_lines(spark, articles_path))
        return work.keep(qg.summarize(articles, qg.read_weights(spark, weights_path, name="tfidf")))


def numbered_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles in page order as text files, numbered by line."""
    with qg.work_folder(spark) as work:
        path = work.at("titles")
        pages(spark, sf_dir).orderBy("page_id").select("title").write.text(path)
        return work.keep(qg.number_lines(qg.read_lines(spark, path)))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        word_count,
        vocabulary,
        vocabulary_keep_empty,
        doc_profile,
        corpus_profile,
        corpus_profile_top,
        token_normalizers,
        parse_articles,
        corpus_size,
        term_freq,
        term_freq_compat,
        doc_freq,
        doc_freq_idf,
        tf_idf,
        tf_idf_compat,
        combine_weights,
        split_sentences,
        sentence_scores,
        attach_scores,
        top_sentences,
        summaries,
        summaries_compat,
        one_article,
        summaries_several,
        parse_links,
        parse_links_all,
        parse_links_compat,
        out_degree,
        dead_ends,
        pagerank_ideal,
        pagerank_taxed,
        pagerank_keep_all,
        pagerank_hubs,
        with_titles,
        top_pages_ideal,
        top_pages_taxed,
        ranked_pages,
        top_pages_compat,
        ranked_lines,
        title_search,
        find_page,
        keyword_subgraph,
        inject_links,
        inject_weighted,
        link_bomb,
        link_bomb_top,
        link_bomb_ranked,
        link_bomb_unbought,
        running_word_count,
        running_word_count_emitted,
        weights_roundtrip,
        links_roundtrip,
        profile_tsv,
        vocabulary_lines,
        doc_profile_lines,
        corpus_profile_lines,
        term_freq_lines,
        term_freq_files,
        summaries_text,
        summarize_weighted,
        numbered_titles,
    )
}
