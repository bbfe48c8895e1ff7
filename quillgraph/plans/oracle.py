"""The same queries as SQL for DuckDB, built from shared common table expressions."""

from __future__ import annotations

KEYWORD = "ring"
TARGET = "large bolt"

# Text


def words(table: str, name: str = "words") -> str:
    return rf"""
{name}_lines AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) AS line
  FROM {table}
),
{name} AS (
  SELECT unnest(string_split(regexp_replace(line, ' +\z', ''), ' ')) AS word
  FROM {name}_lines WHERE NOT regexp_full_match(line, ' +')
)"""


WORD_COUNT = words("documents")

RAW = r"""
raw AS (
  SELECT doc_id, token FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS token FROM documents
  ) WHERE token <> ''
)"""


def strict(col: str) -> str:
    return f"lower(regexp_replace({col}, '[^A-Za-z0-9]', '', 'g'))"


def lax(col: str) -> str:
    return f"lower(regexp_replace({col}, '[^a-zA-Z0-9]\\]', '', 'g'))"


TOKENS = f"""{RAW},
tokens AS (SELECT doc_id, {strict('token')} AS unigram FROM raw WHERE {strict('token')} <> ''),
lax_tokens AS (SELECT doc_id, {lax('token')} AS unigram FROM raw WHERE {lax('token')} <> '')"""


def tf(tokens: str) -> str:
    return f"""
SELECT doc_id, unigram, n, 0.5 + 0.5 * (n::DOUBLE / max(n) OVER (PARTITION BY doc_id)) AS tf
FROM (SELECT doc_id, unigram, count(*) AS n FROM {tokens} GROUP BY doc_id, unigram)"""


IDF = """
SELECT doc_id, unigram,
       log10((SELECT count(*) FROM documents WHERE text <> '')::DOUBLE / count(*) OVER (PARTITION BY unigram)) AS idf
FROM (SELECT DISTINCT doc_id, unigram FROM tokens)"""


def weights(tokens: str = "tokens") -> str:
    return f"""{TOKENS},
tf AS ({tf(tokens)}),
idf AS ({IDF}),
weights AS (
  SELECT doc_id, unigram, coalesce(tf, 1.0) * coalesce(idf, 1.0) AS tfidf
  FROM tf FULL JOIN idf USING (doc_id, unigram)
)"""


WHITE = r"[ \t\n\x0B\f\r]"


def sentences(text: str = "text") -> str:
    return rf"""
cut AS (
  SELECT doc_id, CASE WHEN regexp_full_match({text}, '(\.{WHITE})+') THEN []
    ELSE regexp_split_to_array(regexp_replace({text}, '(\.{WHITE})+\z', ''), '\.{WHITE}') END AS pieces
  FROM documents
),
sentences AS (
  SELECT doc_id, unnest(pieces) AS sentence, generate_subscripts(pieces, 1) - 1 AS pos FROM cut
)"""


def scored(tokens: str = "tokens", text: str = "text") -> str:
    return rf"""{weights(tokens)},{sentences(text)},
sentence_words AS (
  SELECT DISTINCT doc_id, pos, {strict('token')} AS unigram
  FROM (SELECT doc_id, pos, unnest(regexp_split_to_array(sentence, '[ \t\n\r\f]+')) AS token FROM sentences)
),
ranked AS (
  SELECT doc_id, pos, tfidf, rank() OVER (PARTITION BY doc_id, pos ORDER BY tfidf DESC) AS place
  FROM sentence_words JOIN weights USING (doc_id, unigram)
),
sums AS (
  SELECT doc_id, pos, list_reduce(list(tfidf ORDER BY tfidf DESC), lambda a, b: a + b) AS score
  FROM ranked WHERE place <= 5 GROUP BY doc_id, pos
),
scored AS (
  SELECT doc_id, pos, sentence, coalesce(score, 0.0) AS score FROM sentences LEFT JOIN sums USING (doc_id, pos)
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 3
),
summaries AS (
  SELECT d.doc_id, coalesce(string_agg(b.sentence || '. ', '' ORDER BY b.pos), '') AS summary
  FROM documents d LEFT JOIN best b USING (doc_id) GROUP BY d.doc_id
)"""


# The turns of conversations as articles, and of each id's texts the greatest.
TURNS = """
turns AS (SELECT conv_id AS doc_id, text FROM conversations),
chosen AS (SELECT doc_id, max(text) AS text FROM turns WHERE text <> '' GROUP BY doc_id)"""


def several(sql: str) -> str:
    """Weights from all turns, sentences from the chosen one."""
    head, tail = sql.split("cut AS (")
    return f"{TURNS},{head.replace('FROM documents', 'FROM turns')}cut AS ({tail.replace('FROM documents', 'FROM chosen')}"


# Link graph

GRAPH = """
edges AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 2 * l_orderkey + 1 ELSE 2 * l_partkey END AS src,
         CASE l_returnflag WHEN 'N' THEN 2 * l_partkey WHEN 'A' THEN 2 * l_orderkey + 1 ELSE 2 * l_suppkey END AS dst
  FROM lineitem
),
pages AS (
  SELECT 2 * p_partkey AS page_id, p_name AS title FROM part
  UNION ALL SELECT 2 * o_orderkey + 1, 'order ' || o_orderkey FROM orders
)"""

KEPT = f"""{GRAPH},
hits AS (SELECT page_id, title FROM pages WHERE upper(title) LIKE upper('%{KEYWORD}%')),
kept AS (SELECT src, dst FROM edges WHERE src IN (SELECT page_id FROM hits)),
target AS (SELECT min(page_id) AS page_id FROM pages WHERE title = '{TARGET}')"""


def injected(edges: str) -> str:
    return f"""
  SELECT src, dst FROM {edges}
  UNION ALL
  SELECT src, page_id FROM (SELECT DISTINCT src FROM {edges}), target, range(5) WHERE page_id IS NOT NULL"""


def ranks(edges: str, new_rank: str, keep_all: bool = False) -> str:
    """25 rounds as a recursive query; ``new_rank`` is the new rank in terms of ``s``."""
    every_page = f"SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges}"
    start = every_page if keep_all else f"SELECT DISTINCT src AS id FROM {edges}"
    sent = """
      SELECT p.it + 1 AS it, w.dst AS id, p.r * w.copies / d.degree AS part
      FROM rounds p JOIN weighted w ON w.src = p.id JOIN degrees d ON d.src = p.id WHERE p.it < 25"""
    if keep_all:
        sent += " UNION ALL SELECT p.it + 1, p.id, 0.0 FROM rounds p WHERE p.it < 25"
    return f"""
weighted AS MATERIALIZED (SELECT src, dst, count(*)::DOUBLE AS copies FROM {edges} GROUP BY src, dst),
degrees AS MATERIALIZED (SELECT src, count(*)::DOUBLE AS degree FROM {edges} GROUP BY src),
rounds AS (
  SELECT 0 AS it, id, 1.0::DOUBLE AS r FROM ({start})
  UNION ALL
  SELECT it, id, {new_rank} FROM (SELECT it, id, sum(part) AS s FROM ({sent}) GROUP BY it, id)
),
ranks AS (SELECT id AS page_id, r AS rank FROM rounds WHERE it = 25)"""


IDEAL = f"{GRAPH},{ranks('edges', 's')}"
TAXED = f"{GRAPH},{ranks('edges', '0.15 + 0.85 * s')}"
KEEP_ALL = f"{GRAPH},{ranks('edges', '0.15 + 0.85 * s', keep_all=True)}"
BOMB = f"{KEPT},\nbombed AS MATERIALIZED ({injected('kept')}),{ranks('bombed', '0.15 + 0.85 * s')}"

LINKS = """
link_lines AS (
  SELECT l_partkey AS src, l_suppkey AS part, l_partkey AS supp FROM lineitem
)"""

COUNT_LINKS = """
SELECT src, dst, count(*) AS n
FROM (SELECT src, unnest([part, supp, part]) AS dst FROM {lines}) GROUP BY src, dst"""


COUNT_LINKS_COMPAT = COUNT_LINKS.replace("[part, supp, part]", "[part, NULL, supp, part]")


def top(order: str = "rank", titles: str = "pages") -> str:
    return (
        f"SELECT page_id, title, round(rank, 6) AS rank FROM ranks JOIN {titles} USING (page_id) "
        f"ORDER BY {order} DESC, page_id LIMIT 10"
    )


def query(tables: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables}\n{select}"


def numbered_counts(keys: str, order: str) -> str:
    counts = f"SELECT {keys}, count(*) AS n FROM tokens GROUP BY {keys}"
    return f"SELECT row_number() OVER (ORDER BY {order}) AS line, * FROM ({counts})"


COUNT_WORDS = "SELECT word, count(*) AS n FROM words GROUP BY word"
COUNT_UNIGRAMS = "SELECT unigram, count(*) AS n FROM tokens GROUP BY unigram"
TERM_FREQ = "SELECT doc_id, unigram, n, round(tf, 6) AS tf FROM ({}) AS f"
TFIDF = "SELECT doc_id, unigram, round(tfidf, 6) AS tfidf FROM weights"
RANKS = "SELECT page_id, round(rank, 6) AS rank FROM ranks"
EDGES = "SELECT src, dst, count(*) AS n FROM {} AS e GROUP BY src, dst"
DISTINCT_LINKS = "(SELECT DISTINCT l_partkey AS src, l_suppkey AS part, l_partkey AS supp FROM lineitem)"
BOMB_PAGES = "(SELECT * FROM pages WHERE page_id IN (SELECT page_id FROM hits UNION SELECT page_id FROM target)) AS named"
FLAT = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"

ORACLE: dict[str, str] = {
    "word_count": query(WORD_COUNT, COUNT_WORDS),
    "vocabulary": query(TOKENS, "SELECT DISTINCT unigram FROM tokens"),
    "vocabulary_keep_empty": query(RAW, f"SELECT DISTINCT {strict('token')} AS unigram FROM raw"),
    "doc_profile": query(TOKENS, "SELECT doc_id, unigram, count(*) AS n FROM tokens GROUP BY doc_id, unigram"),
    "corpus_profile": query(TOKENS, COUNT_UNIGRAMS),
    "corpus_profile_top": query(TOKENS, COUNT_UNIGRAMS + " ORDER BY n DESC, unigram LIMIT 500"),
    "token_normalizers": query(
        RAW, f"SELECT DISTINCT token, {strict('token')} AS strict, {lax('token')} AS lax FROM raw"
    ),
    "parse_articles": "SELECT source AS title, doc_id::VARCHAR AS doc_id, text FROM documents WHERE text <> ''",
    "corpus_size": "SELECT count(*) AS n_docs FROM documents WHERE text <> ''",
    "term_freq": query(TOKENS, TERM_FREQ.format(tf("tokens"))),
    "term_freq_compat": query(TOKENS, TERM_FREQ.format(tf("lax_tokens"))),
    "doc_freq": query(TOKENS, "SELECT unigram, count(DISTINCT doc_id) AS df FROM tokens GROUP BY unigram"),
    "doc_freq_idf": query(TOKENS, f"SELECT doc_id, unigram, round(idf, 6) AS idf FROM ({IDF}) AS i"),
    "tf_idf": query(weights(), TFIDF),
    "tf_idf_compat": query(weights("lax_tokens"), TFIDF),
    "combine_weights": query(weights("lax_tokens"), TFIDF),
    "split_sentences": query(sentences(), "SELECT doc_id, pos, sentence FROM sentences"),
    "sentence_scores": query(scored(), "SELECT doc_id, pos, round(score, 6) AS score FROM scored"),
    "attach_scores": query(scored(), "SELECT doc_id, pos, sentence, round(score, 6) AS score FROM scored"),
    "top_sentences": query(scored(), "SELECT doc_id, pos, sentence, round(score, 6) AS score FROM best"),
    "summaries": query(scored(), "SELECT doc_id, summary FROM summaries"),
    "summaries_compat": query(scored("lax_tokens"), "SELECT doc_id, summary FROM summaries"),
    "parse_links": "WITH " + "distinct_lines AS " + DISTINCT_LINKS + COUNT_LINKS.format(lines="distinct_lines"),
    "one_article": f"WITH {TURNS} SELECT doc_id, text FROM chosen",
    "summaries_several": query(several(scored()), "SELECT doc_id, summary FROM summaries"),
    "parse_links_compat": "WITH " + "distinct_lines AS " + DISTINCT_LINKS + COUNT_LINKS_COMPAT.format(lines="distinct_lines"),
    "parse_links_all": query(LINKS, COUNT_LINKS.format(lines="link_lines")),
    "out_degree": query(GRAPH, "SELECT src AS page_id, count(*) AS degree FROM edges GROUP BY src"),
    "dead_ends": query(
        GRAPH, "SELECT DISTINCT dst AS page_id FROM edges WHERE dst NOT IN (SELECT src FROM edges)"
    ),
    "pagerank_ideal": query(IDEAL, RANKS, recursive=True),
    "pagerank_taxed": query(TAXED, RANKS, recursive=True),
    "pagerank_keep_all": query(KEEP_ALL, RANKS, recursive=True),
    "pagerank_hubs": query(TAXED, RANKS, recursive=True),
    "ranked_pages": query(
        TAXED,
        "SELECT page_id, title, round(rank, 6) AS rank FROM ranks JOIN pages USING (page_id) ORDER BY ranks.rank DESC, page_id",
        recursive=True,
    ),
    "with_titles": query(
        TAXED, "SELECT page_id, title, round(rank, 6) AS rank FROM ranks JOIN pages USING (page_id)", recursive=True
    ),
    "top_pages_ideal": query(IDEAL, top(), recursive=True),
    "top_pages_taxed": query(TAXED, top(), recursive=True),
    "top_pages_compat": query(TAXED, top("rank::VARCHAR"), recursive=True),
    "ranked_lines": query(
        TAXED, f"SELECT rank::VARCHAR || ' - ' || title AS line FROM ({top()}) AS best", recursive=True
    ),
    "title_search": query(KEPT, "SELECT page_id, title FROM hits"),
    "find_page": query(KEPT, "SELECT page_id FROM target"),
    "keyword_subgraph": query(KEPT, EDGES.format("kept")),
    "inject_links": query(KEPT, EDGES.format(f"({injected('edges')})")),
    "inject_weighted": query(KEPT, EDGES.format(f"({injected('edges')})")),
    "link_bomb_ranked": query(
        BOMB,
        "SELECT page_id, title, round(rank, 6) AS rank FROM ranks JOIN pages USING (page_id) ORDER BY ranks.rank DESC, page_id",
        recursive=True,
    ),
    "link_bomb_unbought": query(f"{KEPT},{ranks('kept', '0.15 + 0.85 * s')}", RANKS, recursive=True),
    "link_bomb": query(BOMB, RANKS, recursive=True),
    "link_bomb_top": query(BOMB, top(titles=BOMB_PAGES), recursive=True),
    "running_word_count": query(WORD_COUNT, COUNT_WORDS),
    "running_word_count_emitted": query(
        words("benchmark", "first") + "," + words("documents", "second"),
        "SELECT 0 AS batch, word, count(*) AS n FROM first GROUP BY word UNION ALL SELECT 1, word, count(*) "
        "FROM (SELECT word FROM first UNION ALL SELECT word FROM second) GROUP BY word",
    ),
    "vocabulary_lines": query(
        TOKENS, "SELECT row_number() OVER (ORDER BY unigram) AS line, unigram FROM (SELECT DISTINCT unigram FROM tokens)"
    ),
    "doc_profile_lines": query(TOKENS, numbered_counts("doc_id, unigram", "doc_id, n DESC, unigram")),
    "corpus_profile_lines": query(TOKENS, numbered_counts("unigram", "n DESC, unigram")),
    "term_freq_lines": query(TOKENS, numbered_counts("doc_id, unigram", "doc_id, unigram")),
    "term_freq_files": query(
        TOKENS,
        "SELECT doc_id, unigram, row_number() OVER (PARTITION BY doc_id ORDER BY unigram) - 1 AS place, 1::BIGINT AS files "
        "FROM (SELECT DISTINCT doc_id, unigram FROM tokens)",
    ),
    "weights_roundtrip": query(weights(), TFIDF),
    "links_roundtrip": "WITH " + "distinct_lines AS " + DISTINCT_LINKS + COUNT_LINKS.format(lines="distinct_lines"),
    "profile_tsv": query(TOKENS, "SELECT unigram || chr(9) || count(*) AS line FROM tokens GROUP BY unigram"),
    "summaries_text": query(
        scored(),
        "SELECT line, count(*) AS n FROM (SELECT unnest(regexp_split_to_array("
        r"doc_id || chr(9) || summary || chr(10), '\r\n|\r|\n')) AS line FROM summaries) GROUP BY line",
    ),
    "summarize_weighted": query(
        scored(text=FLAT), "SELECT doc_id::VARCHAR AS doc_id, summary FROM summaries"
    ),
    "numbered_titles": query(GRAPH, "SELECT row_number() OVER (ORDER BY page_id) AS page_id, title FROM pages"),
}
