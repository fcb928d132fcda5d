"""DuckDB SQL for the rows of the corpus queries that SQL can express, written from their contracts."""

from __future__ import annotations

#: Components by reachability, over nodes (id) and links (a, b) in both directions.
_REACHED = """
reach(id, other) AS (
    SELECT DISTINCT id, id FROM nodes
    UNION
    SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

EMBEDDINGS = f"""
WITH RECURSIVE nodes AS (
    SELECT vec_id AS id, label, embedding::DOUBLE[] AS vec
    FROM embeddings
),
usable AS MATERIALIZED (
    SELECT * FROM nodes
    WHERE id IS NOT NULL AND label IS NOT NULL AND len(vec) > 0
      AND len(list_filter(vec, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(vec, lambda x: x <> 0)) > 0
),
links AS (
    SELECT DISTINCT x.id AS a, y.id AS b
    FROM usable x JOIN usable y ON x.label = y.label AND len(x.vec) = len(y.vec) AND x.id <> y.id
    WHERE list_cosine_similarity(x.vec, y.vec) >= 0.93
),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{_REACHED}
SELECT v.id AS vec_id, coalesce(n, 0) AS n_links, component_id, v.id = component_id AS kept
FROM nodes v LEFT JOIN counted ON v.id = a LEFT JOIN component USING (id)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS html FROM pages
),
digests AS (
    SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
           min(page_id) OVER (PARTITION BY html) AS first_id
    FROM payloads
)
SELECT page_id, url, payload_bytes,
       -- Base32: each five hexadecimal digits are four letters of five bits.
       array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - (i % 4) * 5)) & 31) + 1), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digests
"""

JACCARD = rf"""
WITH RECURSIVE nodes AS (
    SELECT doc_id AS id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT id, array_to_string(words[i : i + 3], ' ') AS shingle
    FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM nodes WHERE len(words) > 0)
),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
sized AS (SELECT id, n, shingle FROM shingles JOIN sizes USING (id)),
links AS (
    SELECT x.id AS a, y.id AS b
    FROM sized x JOIN sized y ON x.shingle = y.shingle AND x.id <> y.id
    WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
    GROUP BY x.id, y.id, x.n, y.n
    HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
),
{_REACHED}
SELECT d.id AS doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM nodes d LEFT JOIN sizes USING (id) LEFT JOIN component USING (id)
"""

FILTER_AUDIT = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
),
parsed AS (
    SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY text) AS first_id
    FROM docs
),
failed AS (
    SELECT doc_id, part,
           len(words) < 200 AS a,
           100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           coalesce(doc_id > first_id, false) AS e
    FROM parsed
),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
    SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM failed LEFT JOIN known USING (doc_id) GROUP BY ALL
),
letters(f, k) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (
    SELECT x.f || y.f || z.f || v.f || w.f AS filter_order, [x.k, y.k, z.k, v.k, w.k] AS seq
    FROM letters x, letters y, letters z, letters v, letters w
    WHERE len(list_distinct([x.k, y.k, z.k, v.k, w.k])) = 5
),
removals AS (
    SELECT m.*, filter_order, seq, coalesce(list_position(list_transform(seq, lambda k: fails[k]), true), 6) AS place
    FROM masks m CROSS JOIN orders
),
steps AS (
    SELECT part, filter_order, step, seq[step] AS k,
           sum(CASE WHEN place > step THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN place = step THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN place < step AND fails[seq[step]] THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN fails[seq[step]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN place = step THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN place = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM removals, (SELECT unnest(range(1, 6))::INT AS step)
    GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, k)::BIGINT AS shapley
FROM steps
"""

ORACLES = {
    "op6_embedding_near_dups": EMBEDDINGS,
    "op7_warc": WARC,
    "op9_ngram_jaccard": JACCARD,
    "op13_filter_audit": FILTER_AUDIT,
}
