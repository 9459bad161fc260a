"""SQL for those of the numbered queries that SQL can express, for DuckDB over the same tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_USABLE = """embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

ORACLE_SQL: dict[str, str] = {
    "op9_exact_dedup": f"""
WITH digests AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
 doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
""",
    "op12_clustering": f"""
WITH RECURSIVE kept AS MATERIALIZED (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE {_USABLE} AND len(embedding) = 64),
first_ones AS (SELECT v, sha256('3:' || vec_id) AS digest FROM kept ORDER BY digest LIMIT 8),
rounds AS (
 SELECT 0 AS round, list(v ORDER BY digest) AS c FROM first_ones
 UNION ALL
 SELECT round + 1, list_transform(range(1, len(c) + 1), lambda j: coalesce(means[j], c[j]))
 FROM (SELECT round, c, map_from_entries(list((k, mean))) AS means
  FROM (SELECT round, c, k, list((total - ((total % n) + n) % n) // n ORDER BY i) AS mean
   FROM (SELECT round, c, k, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
    FROM (SELECT round, c, list_position(d, list_min(d)) AS k, unnest(v) AS x,
      generate_subscripts(v, 1) AS i
     FROM (SELECT round, c, v, list_transform(c, lambda q: CAST(list_sum(list_transform(list_zip(v, q),
       lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)) AS d
      FROM rounds, kept WHERE round < 10))
    GROUP BY ALL)
   GROUP BY round, c, k)
  GROUP BY round, c)),
assigned AS (
 SELECT vec_id, c, list_position(d, list_min(d)) AS k, list_min(d) AS distance
 FROM (SELECT vec_id, c, list_transform(c, lambda q: CAST(list_sum(list_transform(list_zip(v, q),
   lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)) AS d
  FROM rounds, kept WHERE round = 10))
SELECT vec_id, CAST(k - 1 AS INTEGER) AS cluster, distance,
 CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
 CAST(sum(distance) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(c[k], ',')) AS centroid_sha256
FROM assigned
""",
    "op13_topk_search": f"""
WITH vectors AS (
 SELECT vec_id, len(embedding) AS dims,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE {_USABLE}),
scored AS (
 SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v),
  lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
 FROM vectors q JOIN vectors c ON q.dims = c.dims AND q.vec_id != c.vec_id
 WHERE q.vec_id % 50 = 0),
ranked AS (
 SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
  AS INTEGER) AS "rank", vec_id, score FROM scored)
SELECT * FROM ranked WHERE "rank" <= 5
""",
}
