"""What the queries must return, as DuckDB SQL where SQL can express it.

The others are held against brute force in ``tests/llm``: they need token ids, XXH64,
CRC-32 or trained models, which DuckDB has no functions for.
"""

def _round(n: int) -> str:
    """One round of op13: the parts are assigned to the entries of book n, then book n + 1 is made."""
    return f"""
), near{n} AS ({_NEAREST.format(n=n)}
), means{n} AS (
    SELECT p, e, place, sum(x) AS total, count(*) AS n
    FROM (SELECT a.p, a.e, unnest(s.x) AS x, generate_subscripts(s.x, 1) AS place FROM near{n} a JOIN parts s USING (rid, p))
    GROUP BY p, e, place
), book{n + 1} AS (
    SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM book{n} b LEFT JOIN (
        SELECT p, e, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY place) AS y FROM means{n} GROUP BY p, e
    ) m ON m.p = b.p AND m.e = b.e"""


_NEAREST = """
    SELECT rid, p, min(d) AS d, arg_min(e, d * 64 + e) AS e FROM (
        SELECT s.rid, s.p, b.e,
               CAST(list_sum(list_transform(list_zip(s.x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM parts s JOIN book{n} b ON b.p = s.p
    ) GROUP BY rid, p"""

_CODES = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT rid, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x
    FROM kept, (SELECT unnest(range(16)) AS p)
), book0 AS (
    SELECT p, rid - 1 AS e, x AS y FROM parts WHERE rid <= 64{_round(0)}{_round(1)}
), near2 AS ({_NEAREST.format(n=2)}
), coded AS (
    SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near2 GROUP BY rid
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM kept k JOIN coded c ON c.rid = k.rid
"""

ORACLES: dict[str, str] = {
    "op9_cuckoo_line_dedup": """
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT row_id, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM docs
), keyed AS (
    SELECT *, translate(
        trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS last_doc
    FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.row_id, k.doc_id, k.line, k.place, coalesce(r.last_doc <> k.doc_id, false) AS dropped
    FROM keyed k LEFT JOIN repeated r ON r.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row_id, doc_id
""",
    "op12_cover_tree_negatives": """
WITH kept AS (
    SELECT row_number() OVER () AS uid, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid, a.vec_id AS anchor_id, r.uid AS other, r.vec_id, r.label = a.label AS same,
           CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM kept a JOIN kept r ON r.uid <> a.uid WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id, other) AS place
    FROM scored WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.uid, p.place ORDER BY n.score DESC, n.vec_id, n.other) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.uid = p.uid AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
""",
    "op13_value_dictionaries": _CODES,
}
