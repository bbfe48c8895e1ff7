from quillgraph.operators.graph import (
    bomb_pages,
    collapse,
    dead_ends,
    find_page,
    frozen_links,
    inject_links,
    inject_weighted,
    keyword_subgraph,
    link_bomb,
    out_degree,
    pagerank,
    search_titles,
    top_pages,
    with_titles,
)
from quillgraph.operators.numbering import numbered, running_total
from quillgraph.operators.profiles import (
    article_counts,
    corpus_profile,
    doc_profile,
    explode_lines,
    term_counts,
    tokenize,
    tokenize_raw,
    vocabulary,
    word_count,
)
from quillgraph.operators.skew import salted_join
from quillgraph.operators.summarize import (
    attach_scores,
    one_article,
    score_sentences,
    split_sentences,
    summarize,
    top_sentences,
)
from quillgraph.operators.tfidf import article_idf, article_tf, combine_weights, corpus_size, doc_freq, idf, term_freq, tf_idf

__all__ = [
    "article_counts",
    "article_idf",
    "article_tf",
    "attach_scores",
    "bomb_pages",
    "collapse",
    "combine_weights",
    "corpus_profile",
    "corpus_size",
    "dead_ends",
    "doc_freq",
    "doc_profile",
    "explode_lines",
    "find_page",
    "frozen_links",
    "idf",
    "inject_links",
    "inject_weighted",
    "keyword_subgraph",
    "link_bomb",
    "numbered",
    "one_article",
    "out_degree",
    "pagerank",
    "running_total",
    "salted_join",
    "score_sentences",
    "search_titles",
    "split_sentences",
    "summarize",
    "term_counts",
    "term_freq",
    "tf_idf",
    "tokenize",
    "tokenize_raw",
    "top_pages",
    "top_sentences",
    "vocabulary",
    "with_titles",
    "word_count",
]
