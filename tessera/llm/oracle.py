"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tessera.llm.license_scan import COPYRIGHT_LINE, SPELLINGS
from tessera.llm.license_texts import known_licenses

ORACLE_SQL: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """SQL of the canonical text of a column."""
    c = f"replace(lower(coalesce({text}, '')), chr(13), '')"
    c = f"replace(regexp_replace({c}, {_quoted(COPYRIGHT_LINE)}, '', 'g'), '&', ' and ')"
    c = f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for a, b in SPELLINGS:
        c = f"replace({c}, {_quoted(a)}, {_quoted(b)})"
    return c

ORACLE_SQL["op3_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM r
"""

ORACLE_SQL["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""

ORACLE_SQL["op10_license_scan"] = rf"""
WITH licenses(license_id, text) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in known_licenses())}),
known AS (
  SELECT trim(regexp_replace(c, '\s+', ' ', 'g')) AS unit, min(license_id) AS license_id
  FROM (SELECT license_id, {_canonical("text")} AS c FROM licenses) GROUP BY 1
),
docs AS (SELECT doc_id, {_canonical("text")} AS c FROM documents),
units AS (
  SELECT doc_id, unnest(list_distinct(list_concat([c], string_split_regex(c, '\n[ \n]*\n'), string_split(c, chr(10))))) AS unit, c FROM docs
),
found AS (
  SELECT u.doc_id, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS license_ids, count(DISTINCT k.license_id) AS n_licenses,
         min(CASE WHEN trim(regexp_replace(u.c, '\s+', ' ', 'g')) = k.unit THEN k.license_id END) AS whole_license
  FROM units u JOIN known k ON trim(regexp_replace(u.unit, '\s+', ' ', 'g')) = k.unit
  WHERE k.unit <> '' GROUP BY u.doc_id
)
SELECT d.doc_id, coalesce(f.license_ids, '') AS license_ids, coalesce(f.n_licenses, 0) AS n_licenses, f.whole_license
FROM docs d LEFT JOIN found f USING (doc_id)
"""


def _cluster_rounds(rounds: int, k: int, dims: int, scale: int, seed: int) -> str:
    """The rounds one after the other; a floor of a quotient of integers is written out, since ``//`` cuts towards zero."""
    nearest = "min({{'d': list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'k': k}})"
    parts = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT {k})
)"""]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, {nearest.format()} AS near FROM v, c{i} GROUP BY r)")
        if i < rounds:
            parts.append(f"""
s{i} AS (
  SELECT near.k AS k, pos, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM v JOIN a{i} USING (r)) GROUP BY ALL
),
c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c
  FROM c{i} LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS m FROM s{i} GROUP BY k) USING (k)
)""")
    return ",\n".join(parts)


ORACLE_SQL["op13_centroid_clusters"] = f"""
WITH {_cluster_rounds(rounds=10, k=8, dims=64, scale=1024, seed=3)}
SELECT vec_id, near.k::INT AS cluster, near.d AS distance,
       (sum(near.d) OVER (PARTITION BY near.k))::BIGINT AS cluster_inertia, (sum(near.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a10 USING (r) JOIN c10 ON c10.k = near.k
"""

ORACLE_SQL["op12_topk_search"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
