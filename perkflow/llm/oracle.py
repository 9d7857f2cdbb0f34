"""SQL (DuckDB) with the same result as a query, where SQL can express it. It compares plainly, pair by pair."""

from __future__ import annotations

#: CRC-32 of the decimal digits of a number, bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({n}::VARCHAR) + 1), "
    "lambda i: ord(substr({n}::VARCHAR, i, 1))::BIGINT)), lambda a, b: "
    "list_reduce(list_prepend(xor(a, b), range(8)), "
    "lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), "
    "4294967295::BIGINT)"
)

_TRIE = f"""
WITH t AS MATERIALIZED (
    SELECT conv_id, mark, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos
    FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
                 substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS mark
          FROM conversations WHERE conv_id IS NOT NULL)),
c AS MATERIALIZED (
    SELECT conv_id, conv_id - conv_id % 5 AS lead, {_CRC.format(n="conv_id")} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
r AS MATERIALIZED (
    SELECT c.conv_id, 0 AS half, t.pos, t.mark, t.size FROM c JOIN t ON t.conv_id = c.lead AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1 AS half, t.pos, t.mark, t.size FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
p AS MATERIALIZED (
    SELECT c.conv_id, coalesce(list(r.mark ORDER BY half, pos) FILTER (r.mark IS NOT NULL), []) AS marks,
           coalesce(list(r.size ORDER BY half, pos) FILTER (r.mark IS NOT NULL), []) AS sizes
    FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
x AS (
    SELECT conv_id, marks, sizes, unnest(range(0, len(marks) + 1)) AS d FROM p),
n AS MATERIALIZED (
    SELECT d, array_to_string(marks[1:d], '') AS key, min(conv_id) AS conv_id, count(*) AS n,
           any_value(CASE WHEN d > 0 THEN array_to_string(marks[1:d - 1], '') END) AS above,
           any_value(CASE WHEN d > 0 THEN sizes[d] ELSE 0 END) AS size,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(marks) = d), '') AS ends
    FROM x GROUP BY d, key),
k AS (SELECT d - 1 AS d, above AS key, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
m AS MATERIALIZED (SELECT n.*, coalesce(k.children, 0) AS children FROM n LEFT JOIN k USING (d, key)),
s AS (
    SELECT a.d, a.key, count(*) FILTER (b.children = 0) AS leaves, sum((b.n - 1) * b.size) AS saved
    FROM m a JOIN m b ON b.d >= a.d AND starts_with(b.key, a.key) GROUP BY a.d, a.key)
SELECT m.conv_id, m.d::BIGINT AS depth, up.conv_id AS parent_conv_id, m.n::BIGINT AS n_convs,
       m.children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(m.ends) AS ends_sha256
FROM m JOIN s USING (d, key) LEFT JOIN n up ON up.d = m.d - 1 AND up.key = m.above
"""


def _rounds(number: int) -> str:
    parts = []
    for i in range(number + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
    SELECT rid, cluster, distance FROM (
        SELECT rid, c AS cluster, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - w[i]) * (k.v[i] - w[i]))) AS distance
        FROM k, c{i})
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1)""")
        if i < number:
            parts.append(f"""
m{i} AS (
    SELECT cluster AS c, place, sum(x) AS s, count(*) AS n
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS place FROM a{i} JOIN k USING (rid)) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
    SELECT c{i}.c, coalesce(g.w, c{i}.w) AS w
    FROM c{i} LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS w FROM m{i} GROUP BY c) g USING (c))""")
    return ",".join(parts)


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_CLUSTERS = f"""
WITH k AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS rid,
           list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {_USABLE}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST) - 1 AS c, v AS w FROM k
    QUALIFY c < 16),{_rounds(3)}
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a3 JOIN k USING (rid) JOIN c3 ON c3.c = cluster
"""

_TOPK = f"""
WITH k AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS rid,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE {_USABLE})
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT q.vec_id AS query_id, c.vec_id, score,
           row_number() OVER (PARTITION BY q.rid ORDER BY score DESC, c.vec_id) AS rank
    FROM (SELECT * FROM k WHERE vec_id % 50 = 0) q JOIN k c ON len(c.v) = len(q.v) AND c.rid <> q.rid,
         LATERAL (SELECT coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score))
WHERE rank <= 5
"""

#: Words as runs of letters and digits in lower case.
_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"

_LM = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS words FROM documents),
w AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
t AS MATERIALIZED (
    SELECT rid, w.doc_id IS NOT NULL AS wanted, unnest(words) AS word, unnest(range(len(words))) AS pos,
           unnest(list_prepend('', words)[1:len(words)]) AS prev
    FROM d LEFT JOIN w USING (doc_id)),
p AS MATERIALIZED (
    SELECT prev, word, count(*) AS b, count(*) FILTER (wanted) AS t FROM t GROUP BY ALL),
o AS (
    SELECT prev AS word, sum(b) AS open_b, sum(t) AS open_t, count(*) AS kinds_b, count(*) FILTER (t > 0) AS kinds_t
    FROM p GROUP BY 1),
c AS (SELECT word, sum(b) AS b, sum(t) AS t FROM p GROUP BY 1),
n AS (SELECT sum(b) AS b, sum(t) AS t, count(*) + 1 AS size FROM c),
v AS MATERIALIZED (
    SELECT coalesce(c.word, o.word) AS word, coalesce(c.b, 0) AS b, coalesce(c.t, 0) AS t,
           greatest(coalesce(c.b, 0), coalesce(open_b, 0), 1) AS under_b, greatest(coalesce(c.t, 0), coalesce(open_t, 0), 1) AS under_t,
           coalesce(open_b - 0.5 * kinds_b, 0) AS direct_b, coalesce(open_t - 0.5 * kinds_t, 0) AS direct_t
    FROM c FULL JOIN o ON c.word = o.word),
l AS MATERIALIZED (
    SELECT p.prev, p.word,
           -ln(greatest(p.b - 0.5, 0)::DOUBLE / f.under_b
               + greatest(1 - f.direct_b::DOUBLE / f.under_b, 1e-9) * ((s.b + 1)::DOUBLE / (n.b + n.size))) AS lb,
           -ln(greatest(p.t - 0.5, 0)::DOUBLE / f.under_t
               + greatest(1 - f.direct_t::DOUBLE / f.under_t, 1e-9) * ((s.t + 1)::DOUBLE / (n.t + n.size))) AS lt
    FROM p JOIN v f ON f.word = p.prev JOIN v s ON s.word = p.word, n),
x AS (SELECT rid, avg(lb) AS lb, avg(lt) AS lt FROM t JOIN l ON l.prev = t.prev AND l.word = t.word GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_tokens, round(lt, 6) AS loss_target, round(lb, 6) AS loss_background,
       round(lt - lb, 6) AS ce_diff
FROM d LEFT JOIN x USING (rid)
"""

#: Smallest name among the rows that links connect, for rows r (rid, name) and pairs e (a, b) of both directions.
_REACH = """
reach(rid, other) AS (
    SELECT rid, rid FROM r
    UNION
    SELECT reach.rid, e.b FROM reach JOIN e ON e.a = reach.other),
named AS (SELECT reach.rid, min(r.name) AS name FROM reach JOIN r ON r.rid = reach.other GROUP BY 1)"""

_JOIN = f"""
WITH RECURSIVE d AS (
    SELECT doc_id AS name, row_number() OVER () AS rid, {_WORDS} AS words FROM documents),
r AS MATERIALIZED (SELECT rid, name FROM d),
s AS MATERIALIZED (
    SELECT DISTINCT rid, unnest(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
           lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
    FROM d WHERE len(words) > 0),
k AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.rid AS a, b.rid AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY ALL),
e AS MATERIALIZED (
    SELECT a, b FROM i JOIN k x ON x.rid = a JOIN k y ON y.rid = b WHERE common * 10 >= 8 * (x.n + y.n - common)),
{_REACH}
SELECT r.name AS doc_id, named.name AS class_id, (SELECT count(*) FROM e WHERE e.a = r.rid)::BIGINT AS n_links
FROM r JOIN named USING (rid)
"""

_VECTORS = f"""
WITH RECURSIVE r AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id AS name, embedding::DOUBLE[] AS v,
           coalesce(embedding IS NOT NULL AND len(embedding) > 0
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good
    FROM embeddings),
e AS MATERIALIZED (
    SELECT x.rid AS a, y.rid AS b FROM r x JOIN r y ON x.rid <> y.rid AND x.good AND y.good AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
{_REACH}
SELECT r.name AS vec_id, (SELECT count(*) FROM e WHERE e.a = r.rid)::BIGINT AS n_links, named.name AS component_id,
       coalesce(r.name = named.name, false) AS kept
FROM r JOIN named USING (rid)
"""

_ARCHIVE = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""

SQL: dict[str, str] = {
    "op1_lm_scoring": _LM,
    "op2_ngram_join": _JOIN,
    "op6_embedding_dedup": _VECTORS,
    "op9_warc": _ARCHIVE,
    "op11_prefix_trie": _TRIE,
    "op12_centroid_clusters": _CLUSTERS,
    "op13_vector_topk": _TOPK,
}
