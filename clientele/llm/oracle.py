"""DuckDB SQL for the queries that SQL can express on whole tables, written apart from the operators.

Brute force by plain joins: it finds what the indexes of the operators must find. It is meant for the small test sets.
"""

from __future__ import annotations

#: The smallest id reachable by links ``l (a, b)``, both ways, from each node ``n (id)``; UNION ends at no news.
REACHED = """reached AS (
        SELECT id, id AS other FROM nodes
        UNION
        SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other)"""

#: Distinct pairs of neighbouring words, as texts; the whole sequence where there are fewer words.
NEAR_COPIES = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents),
    items AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
            ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS item
        FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
    links AS (
        SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 80 * (p.n + q.n - c)),
    nodes AS (SELECT doc_id AS id FROM documents),
    {REACHED},
    named AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
    SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, m.component_id,
           d.doc_id = m.component_id AS kept
    FROM documents d JOIN named m ON m.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

NEAR_VECTORS = f"""
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
          AND len([x for x in embedding if x <> 0]) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
        WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.93),
    nodes AS (SELECT vec_id AS id FROM embeddings),
    {REACHED},
    named AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
    SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, m.component_id,
           e.vec_id = m.component_id AS kept
    FROM embeddings e JOIN named m ON m.id = e.vec_id"""

#: Every pair of equal lines lies on a diagonal; neighbours on one diagonal are a repeated run. Ids are unique here.
LINE_RUNS = """
    WITH split AS (
        SELECT doc_id, string_split(text, chr(10)) AS own FROM documents WHERE text IS NOT NULL),
    places AS (SELECT doc_id, unnest(own) AS own, unnest(range(len(own))) AS line FROM split),
    lines AS (
        SELECT doc_id, own, line, CASE WHEN trim(own) = '' THEN 0
            ELSE len(trim(own)) - len(replace(trim(own), ' ', '')) + 1 END AS words
        FROM places),
    again AS (
        SELECT y.doc_id AS earlier, x.doc_id, x.line, x.words, x.line - y.line AS diagonal
        FROM lines x JOIN lines y ON x.own = y.own AND (y.doc_id < x.doc_id OR (y.doc_id = x.doc_id AND y.line < x.line))),
    stretches AS (
        SELECT *, line - row_number() OVER (PARTITION BY earlier, doc_id, diagonal ORDER BY line) AS stretch FROM again),
    runs AS (
        SELECT doc_id, line, sum(words) OVER (PARTITION BY earlier, doc_id, diagonal, stretch) AS words FROM stretches),
    gone AS (SELECT DISTINCT doc_id, line FROM runs WHERE words >= 50),
    rest AS (
        SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_deleted,
               coalesce(string_agg(l.own, chr(10) ORDER BY l.line) FILTER (WHERE g.line IS NULL), '') AS kept
        FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line GROUP BY l.doc_id)
    SELECT d.doc_id, CAST(coalesce(r.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n_deleted, 0) AS BIGINT) AS n_deleted,
           md5(r.kept) AS kept_md5
    FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id"""

#: The archive laid out by windows over whole tables; a drill's faults follow from the ids.
FIXITY = """
    WITH payloads AS (
        SELECT page_id, coalesce('=' || page_id, '') AS name, html IS NULL AS missing,
            'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:sha256:' || sha256(html)
            || '>' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e || 'Content-Type: text/html'
            || e || 'Content-Length: ' || strlen(html) || e || e || html || e || e AS body
        FROM pages, (SELECT chr(13) || chr(10) AS e)),
    named AS (
        SELECT page_id, missing, coalesce(strlen(body), 0) AS length, coalesce(sha256(body), 'missing') AS content,
            md5(name || ' ' || coalesce(sha256(body), 'missing')) AS digest
        FROM payloads),
    copies AS (SELECT *, row_number() OVER (PARTITION BY digest) - 1 AS copy FROM named),
    files AS (SELECT greatest(1, (count(*) + 255) // 256) AS n FROM pages),
    dealt AS (
        SELECT c.*, CAST('0x' || substr(md5(digest || ':' || copy), 1, 8) AS BIGINT) * n // 4294967296 AS file
        FROM copies c, files),
    places AS (
        SELECT *, row_number() OVER own - 1 AS record,
            CAST(coalesce(sum(length) OVER (own ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin_offset
        FROM dealt WINDOW own AS (PARTITION BY file ORDER BY page_id NULLS FIRST, digest, copy))
    SELECT page_id, file, record, begin_offset, CAST(length AS BIGINT) AS length,
        sha256(record || ':' || begin_offset || ':' || length || ':' || content) AS leaf_sha256,
        CASE WHEN page_id % 101 <> 0 OR page_id IS NULL THEN 'intact' WHEN page_id % 2 = 0 THEN 'lost'
            WHEN missing THEN 'intact' ELSE 'changed' END AS status
    FROM places"""


def all_sql() -> dict[str, str]:
    return {"op3_minhash": NEAR_COPIES, "op4_pivot_permutations": NEAR_VECTORS, "op5_merkle_audit": FIXITY, "op8_line_runs": LINE_RUNS}
