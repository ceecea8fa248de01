"""DuckDB SQL of the queries whose whole result SQL can express (see ``repeats.sql`` and ``codes.sql``
for two more)."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
    d AS (SELECT *, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
    o AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS owner FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND owner > page_id THEN 'revisit' ELSE 'response' END
            AS record_type,
        CASE WHEN payload_bytes >= 1000 AND owner > page_id THEN owner END AS refers_to,
        url AS target_uri
    FROM o"""

OP8 = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x:
        floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5"""

OP10 = f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex({LOWER.format(
    "coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS sh FROM (
            SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0))),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b
        ON a.sh = b.sh AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id
        JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
        UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
    least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least c USING (doc_id)"""
