"""SQL of the operators whose steps take many common table expressions: 12 and 13."""

from __future__ import annotations

from .centroids import ClusterParams
from .resampling import ResampleParams


def _cluster_sql(params: ClusterParams) -> str:
    """K-means in whole numbers, a round at a time, with the plain squared distance."""
    names = [f"c{i}" for i in range(params.rounds + 1)]
    steps = []
    for i in range(params.rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, v, unnest(arg_min(struct_pack(cluster := cluster, distance := distance), (distance, cluster)), recursive := true)
  FROM (SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
        FROM kept, {names[i]}) GROUP BY vec_id, v)""")
        if i < params.rounds:
            steps.append(f"""moved{i} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c
  FROM (SELECT cluster, d, sum(v[d])::BIGINT AS s, count(*) AS n FROM near{i}, range(1, {params.size + 1}) AS t(d) GROUP BY ALL)
  GROUP BY cluster),
{names[i + 1]} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM {names[i]} o LEFT JOIN moved{i} m USING (cluster))""")
    last = params.rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({params.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {params.size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {params.size}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id) - 1 AS cluster, v AS c
  FROM (SELECT vec_id, v, sha256('{params.salt}:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h, vec_id LIMIT {params.k})),
{", ".join(steps)}
SELECT vec_id, cluster::INT AS cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{last} JOIN c{last} USING (cluster)
"""


def _resample_sql(params: ResampleParams) -> str:
    """The checksum is written out byte by byte, over the different features."""
    return f"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS c FROM range(256) AS t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
words AS MATERIALIZED (
  SELECT kind, r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM texts),
features AS MATERIALIZED (
  SELECT kind, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
hashed AS MATERIALIZED (
  SELECT f, (xor(list_reduce(list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) % {params.buckets})::INT AS b
  FROM (SELECT DISTINCT f FROM features), tab),
counts AS (
  SELECT b, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM features JOIN hashed USING (f) GROUP BY b),
sums AS (SELECT sum(s)::BIGINT + {params.buckets} AS all_s, sum(t)::BIGINT + {params.buckets} AS all_t FROM counts),
gains AS (
  SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * all_s::DOUBLE) / ((s + 1)::DOUBLE * all_t::DOUBLE)))::BIGINT AS gain FROM counts, sums),
sized AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS total
  FROM features JOIN hashed USING (f) JOIN gains USING (b) WHERE kind = 0 GROUP BY r),
weighed AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, len(w) AS n_words,
    CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
    ('0x' || substr(sha256('{params.salt}:' || doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) JOIN words USING (r) LEFT JOIN sized USING (r) WHERE kind = 0),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score FROM weighed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {params.least_words} ORDER BY score DESC, doc_id) AS place,
    {params.percent} * count(*) FILTER (n_words >= {params.least_words}) OVER () // 100 AS wanted FROM scored)
SELECT doc_id, n_features, weight::BIGINT AS weight, score, CASE WHEN n_words >= {params.least_words} AND place <= wanted THEN place END AS rank
FROM ordered
"""


CLUSTER_SQL = _cluster_sql(ClusterParams())
RESAMPLE_SQL = _resample_sql(ResampleParams())
