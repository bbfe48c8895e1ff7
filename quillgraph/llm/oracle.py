"""SQL for the queries of this subpackage that SQL can express.

The scores, token counts, removed bytes, searches and schedules need methods
that SQL has not; those queries are held against brute force in tests/llm.
"""

from __future__ import annotations

#: Integer inner products of every 50th vector with all others; vectors that may not take part have no ``v``.
TOP_K = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""



def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str, start: str) -> str:
    """All nodes of the trees over ``start``, and what stands before and after each in its run of sixteen."""
    run = "PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN"
    return f"""
{name} AS (
  SELECT 0 AS level, tree, idx, n, hash FROM ({start})
  UNION ALL
  SELECT level + 1, tree, idx // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY level, tree, idx // 16, n
),
{name}_beside AS (
  SELECT *, coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}
)"""


def _walk(name: str, tree: str, start: str) -> str:
    """From each row ``(row, tree, idx, acc, proof)`` of ``start`` up to the last node of its tree."""
    return f"""
{name} AS (
  SELECT 0 AS level, row, tree, idx, acc, proof FROM ({start})
  UNION ALL
  SELECT w.level + 1, w.row, w.tree, w.idx // 16, sha256(b.before || w.acc || b.after), w.proof || b.before || b.after
  FROM {name} w JOIN {tree}_beside b ON b.tree = w.tree AND b.level = w.level AND b.idx = w.idx AND b.n > 1
),
{name}_end AS (SELECT w.row, w.tree, w.acc, w.proof FROM {name} w JOIN {tree} t ON t.tree = w.tree AND t.level = w.level AND t.idx = w.idx AND t.n = 1)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB has no crc32, so the rows to tamper with come from a bitwise version of it over the digits of the id.
_CRC = """
digits AS (SELECT row, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT) AS d FROM leaves WHERE doc_id IS NOT NULL),
crc AS (
  SELECT row, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, d), lambda c, x:
    list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384::UBIGINT)))) AS crc
  FROM digits
)"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, leaf, claimed, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS row
  FROM (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf(_LOWERED)} AS claimed FROM documents)
),{_CRC},
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n, min(row) AS start FROM leaves GROUP BY source),
placed AS (
  SELECT l.row, l.doc_id, l.leaf, CASE WHEN crc % 5 = 0 THEN claimed ELSE leaf END AS claimed, tree, n, l.row - start AS idx
  FROM leaves l JOIN sources s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN crc USING (row)
),{_tree("lower_tree", "SELECT tree, idx, n, leaf AS hash FROM placed")},
subroots AS (SELECT tree, hash FROM lower_tree WHERE n = 1),{_tree("upper_tree", "SELECT 0 AS tree, tree AS idx, (SELECT count(*) FROM sources) AS n, hash FROM subroots")},
root AS (SELECT hash AS root FROM upper_tree WHERE n = 1),{_walk("lower_walk", "lower_tree", "SELECT row, tree, idx, claimed AS acc, '' AS proof FROM placed")},{_walk("upper_walk", "upper_tree", "SELECT row, 0 AS tree, tree AS idx, acc, proof FROM lower_walk_end")}
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(w.proof) AS proof_sha256, w.acc AS folded_root, w.acc = root AS verified
FROM placed p JOIN subroots s USING (tree) JOIN upper_walk_end w ON w.row = p.row, root
"""

#: Positives and negatives by exact scores of every 50th vector with all others.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE: dict[str, str] = {"op8_top_k": TOP_K, "op11_hard_negatives": HARD_NEGATIVES, "op12_merkle": MERKLE}
