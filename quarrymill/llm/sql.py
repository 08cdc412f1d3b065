"""DuckDB's SQL of the deduplicating queries, from their definitions: every window, set and pair is compared."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: reach, from links (a, b) in both directions, and the rows' nodes: the smallest that links reach.
_REACH = """reach AS (SELECT a AS node, b AS other FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
low AS (SELECT node, min(other) AS other FROM reach GROUP BY node)"""

EMBEDDINGS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
pairs AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), {_REACH},
many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.other, vec_id)) AS component_id, vec_id <= coalesce(low.other, vec_id) AS kept
FROM embeddings LEFT JOIN many ON many.a = vec_id LEFT JOIN low ON low.node = vec_id"""

MINHASH = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' '))) END AS sh FROM w),
e AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
pairs AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), {_REACH}
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.other, doc_id)) AS component_id, doc_id <= coalesce(low.other, doc_id) AS kept
FROM s LEFT JOIN low ON low.node = doc_id"""


def _removed(units: str, window: int) -> str:
    """Common tables: u (doc_id, i, x) are units and their places; k has `gone` for those that a repeated window covers."""
    return f"""{units},
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY hash) AS many FROM m) WHERE many > 1),
k AS (SELECT u.doc_id, u.i, u.x, coalesce(max(h.i) OVER (PARTITION BY u.doc_id ORDER BY u.i) > u.i - {window}, false) AS gone
  FROM u LEFT JOIN h ON h.doc_id = u.doc_id AND h.i = u.i)"""


SUBSTRINGS = f"""WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents), {_removed('''
u AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
m AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS hash FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35))''', 35)},
g AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM k GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id)"""

SUFFIXES = f"""WITH w AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents), {_removed('''
u AS (SELECT doc_id, i, substr(t, CAST(2 * i + 1 AS BIGINT), 2) AS x FROM (SELECT doc_id, t, unnest(range(0, length(t) // 2)) AS i FROM w)),
m AS MATERIALIZED (SELECT doc_id, i, md5(substr(t, CAST(2 * i + 1 AS BIGINT), 400)) AS hash FROM (SELECT doc_id, t, unnest(range(0, length(t) // 2 - 199)) AS i FROM w WHERE length(t) >= 400))''', 200)},
l AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM k),
g AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans, coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM l GROUP BY doc_id)
SELECT doc_id, CAST(length(t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id)"""
