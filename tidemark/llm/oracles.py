"""DuckDB SQL for the queries that SQL can express on whole tables."""

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

OP4 = rf"""
WITH sized AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sized GROUP BY source),
ratio AS (SELECT *, 3.0::DOUBLE * source_size / weight AS cap FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
           FROM ratio WINDOW o AS (ORDER BY cap, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT arg_min(level, cap) FILTER (level <= cap) AS t FROM levels),
targets AS (SELECT source, source_size, least(t * weight, (3 * source_size)::DOUBLE) AS target FROM levels, t),
docs AS (SELECT d.*, source_size, target, floor(target / source_size) AS whole,
                target - floor(target / source_size) * source_size AS rest,
                (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u,
                size * 200 > source_size AS is_long
         FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
odds AS (SELECT *, rest / source_size AS p,
                CASE WHEN rest > 0 THEN u / (1 - u) * ((1 - rest / source_size) / (rest / source_size)) END AS q FROM docs),
ranks AS (SELECT *, CASE WHEN q IS NULL THEN 1.0 ELSE q / (1 + q) END AS pos FROM odds),
long_docs AS (SELECT *, p > 0 AND sum(size) OVER (PARTITION BY source ORDER BY pos, doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0
                        <= rest * (sum(size) OVER (PARTITION BY source) / source_size) AS extra FROM ranks WHERE is_long),
long_taken AS (SELECT source, sum(size) AS taken FROM long_docs WHERE extra GROUP BY source),
others AS (SELECT r.*, p > 0 AND sum(size) OVER (PARTITION BY r.source ORDER BY pos, doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0
                       <= rest - coalesce(l.taken, 0) AS extra
           FROM ranks r LEFT JOIN long_taken l ON r.source IS NOT DISTINCT FROM l.source WHERE NOT is_long)
SELECT doc_id, size, source_size, target, (size * (whole + extra::INT))::BIGINT AS taken
FROM (SELECT doc_id, size, source_size, target, whole, extra FROM long_docs
      UNION ALL SELECT doc_id, size, source_size, target, whole, extra FROM others)
"""

OP5 = """
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
              FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""

OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, hash(unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END)) AS sh FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (sh)
           WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, l.b FROM reach r JOIN edges l ON r.b = l.a),
component AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN component ON a = d.doc_id
"""

OP11 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def _kmeans(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """Lloyd's rounds written out one after the other, every vector against every centroid."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    parts = [f"""
v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, x FROM v
       ORDER BY sha256('2:' || vec_id) LIMIT {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, any_value(v.x) AS x, min({{'d': {distance}, 'k': c.k}}) AS best FROM v, c{r} c GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (SELECT best.k AS k, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, {size + 1}) t(i) GROUP BY ALL),
m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.k = c.k)""")
    return f"""WITH {','.join(parts)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = best.k
"""


ORACLES = {"op4_mix_sources": OP4, "op5_exact_dedup": OP5, "op7_minhash": OP7, "op11_warc_revisits": OP11,
           "op12_heap_kmeans": _kmeans()}
