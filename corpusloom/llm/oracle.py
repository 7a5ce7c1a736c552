"""DuckDB SQL for the rows of the queries that SQL can express, by plain definitions."""

from __future__ import annotations

FINITE = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))"


def clusters(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """op11: assignment and update of centroids, unrolled."""
    parts = [
        f"""x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)) AS v
        FROM embeddings WHERE len(embedding) = {dims} AND {FINITE})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
        FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM x WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, v, list_min(list([d, c])) AS best FROM (
            SELECT x.vec_id, x.v, c{r}.c, list_sum(list_transform(list_zip(x.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM x, c{r}) GROUP BY vec_id, v)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (SELECT c, list(s ORDER BY i) AS v FROM (SELECT best[2] AS c, i, floor(sum(v[i]) / count(*)) AS s
                FROM a{r}, unnest(range(1, {dims + 1})) AS u(i) GROUP BY 1, 2) GROUP BY c)"""
            )
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} AS o LEFT JOIN m{r} AS m ON o.c = m.c)")
    return f"""WITH {", ".join(parts)}
    SELECT a.vec_id, c.c::INTEGER AS cluster, best[1]::BIGINT AS distance,
    (sum(best[1]) OVER (PARTITION BY c.c))::BIGINT AS cluster_inertia, (sum(best[1]) OVER ())::BIGINT AS inertia,
    sha256(list_aggregate(list_transform(c.v, lambda e: e::BIGINT), 'string_agg', ',')) AS centroid_sha256
    FROM a{rounds} AS a JOIN c{rounds} AS c ON a.best[2] = c.c"""


TRIE = r"""WITH RECURSIVE crc AS (
    SELECT conv_id, conv_id::VARCHAR AS s, 0 AS step, 4294967295::BIGINT AS v
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    UNION ALL
    SELECT conv_id, s, step + 1, xor(x >> 1, 3988292384 * (x & 1)) FROM (
        SELECT conv_id, s, step, CASE WHEN step % 8 = 0 THEN xor(v, ascii(s[step // 8 + 1])) ELSE v END AS x
        FROM crc WHERE step < 8 * length(s))),
head AS (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE step = 8 * length(s)),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS MATERIALIZED (SELECT role, text, row_number() OVER (ORDER BY role, text) AS id,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM (SELECT DISTINCT role, text FROM t)),
own AS MATERIALIZED (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, role, text) AS ids FROM t JOIN named USING (role, text) GROUP BY conv_id),
built AS (SELECT o.conv_id, coalesce(b.ids[1:h], []) || o.ids[h + 1:] AS seq
    FROM own AS o JOIN head USING (conv_id) LEFT JOIN own AS b ON b.conv_id = o.conv_id - o.conv_id % 20),
node AS MATERIALIZED (SELECT seq[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
    string_agg(CASE WHEN len(seq) = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
    FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM built) GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
worth AS MATERIALIZED (SELECT node.*, coalesce(k, 0) AS k, (n - 1) * coalesce(words, 0) AS saved
    FROM node LEFT JOIN kids ON node.p = kids.p LEFT JOIN named ON named.id = node.p[d]),
below AS (SELECT p[1:a] AS p, sum(saved) AS saved, count(*) FILTER (k = 0) AS leaves
    FROM (SELECT p, saved, k, unnest(range(0, d + 1)) AS a FROM worth) GROUP BY 1)
SELECT w.conv_id, w.d::BIGINT AS depth, up.conv_id AS parent_conv_id, w.n AS n_convs, w.k AS n_children, leaves AS n_leaves,
    below.saved::BIGINT AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM worth AS w JOIN below ON w.p = below.p LEFT JOIN node AS up ON w.d > 0 AND up.p = w.p[1:w.d - 1]"""


def links(threshold: float = 0.95) -> str:
    """op13: every pair."""
    return f"""WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, len(embedding) AS n, list_transform(embedding, lambda x: x::DOUBLE) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND {FINITE} AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id AND a.n = b.n
        WHERE list_cosine_similarity(a.v, b.v) >= {threshold}),
    reach AS (SELECT vec_id AS id, vec_id AS low FROM embeddings UNION SELECT id, link.b FROM reach JOIN link ON link.a = low),
    least AS (SELECT id, min(low) AS low FROM reach GROUP BY id)
    SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, low AS component_id, vec_id = low AS kept
    FROM embeddings JOIN least ON id = vec_id"""
