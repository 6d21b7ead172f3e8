"""DuckDB SQL of the registered training-data queries that SQL can express on whole tables."""

from __future__ import annotations

OP1 = """
WITH v AS (SELECT vec_id, [floor(1024.0 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
      WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP10 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE doc_id IS NOT NULL AND length(key) >= 20
      GROUP BY key HAVING count(DISTINCT r) >= 3),
j AS (SELECT r, k.doc_id, line, i, coalesce(k.doc_id <> c.last, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""

OP11 = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST) = 1 AS kept, h AS text_sha256
FROM d
"""

ORACLE_SQL: dict[str, str] = {"op1_va_search": OP1, "op10_line_dedup": OP10, "op11_exact_dedup": OP11}
