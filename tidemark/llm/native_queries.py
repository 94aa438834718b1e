"""Queries of the operators that are DataFrame functions only: 1, 5 and 10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .exact_dedup import exact_dedup
from .mixing import DIGITS, PART, TERMS, mix_sources
from .registry import query
from .secrets import BASE, RULES, join_back, joined, scan_versions

# Production parameters of the mixture: shares tempered by a square root, as many rows as the input on average.
MIX_ALPHA = 0.5
MIX_SEED = 20_24

MIX_SQL = f"""
WITH sizes AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(n, {MIX_ALPHA}) / sum(pow(n, {MIX_ALPHA})) OVER () * sum(n) OVER () / n AS rate FROM sizes),
parts AS (SELECT source, rate, greatest(1, ceil(rate / {PART}))::INT AS parts FROM rates),
terms AS (
  SELECT source, k, parts, exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1) AS term
  FROM parts, range({TERMS + 1}) AS t(k)),
cdf AS (SELECT source, k, parts, sum(term) OVER (PARTITION BY source ORDER BY k) AS p FROM terms),
lists AS (SELECT source, any_value(parts) AS parts, list(p ORDER BY k) AS cdf FROM cdf GROUP BY source),
counted AS (
  SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf, lambda p: p <=
    ('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || i), 1, {DIGITS}))::BIGINT::DOUBLE
      / {16**DIGITS}.0))))::BIGINT AS mix_copies
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, mix_copies, mix_copy,
  md5('order:{MIX_SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || mix_copy) AS mix_key
FROM (SELECT *, unnest(range(1, mix_copies + 1)) AS mix_copy FROM counted)
"""


@query("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated towards tempered shares of their sources."""
    return mix_sources(table(spark, sf_dir, "documents"), MIX_ALPHA, seed=MIX_SEED)


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, sha256(n) AS text_sha256
FROM t WINDOW g AS (PARTITION BY n)
"""


@query("op5_exact_dedup", EXACT_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def _secret_hits() -> str:
    quoted = [(i, r.kind, r.pattern.replace("'", "''"), r.group, r.least) for i, r in enumerate(RULES)]
    one = """
  SELECT doc_id, {0} AS rank, '{1}' AS kind, {4} AS least,
    list_transform(regexp_extract_all(t, '{2}'), lambda x: length(x)) AS hits,
    list_transform(regexp_extract_all(t, '{2}', {3}), lambda x: length(x)) AS judged,
    list_transform(string_split_regex(t, '{2}'), lambda x: length(x)) AS gaps FROM docs"""
    return " UNION ALL ".join(one.format(*q) for q in quoted)


SECRET_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({_secret_hits()}),
places AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM hits),
spans AS (
  SELECT doc_id, rank, kind, list_sum(gaps[1:i])::BIGINT + coalesce(list_sum(hits[1:i - 1]), 0)::BIGINT AS start, hits[i] AS size
  FROM places WHERE judged[i] >= least),
named AS (SELECT doc_id, rank, kind, start, kind || ':' || start || ':' || (start + size) AS span FROM spans),
per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (doc_id)
"""


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query("op10_secret_scan", SECRET_SQL)
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run: the ledger is empty, so every blob is unseen for every rule."""
    result = scan_versions(table(spark, sf_dir, "documents"))
    found = join_back(result.versions, result.findings)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    count = {r.kind: _of_kind(r.kind) for r in BASE}
    return found.select(
        F.col("path").alias("doc_id"),
        *[n.alias(f"n_{kind}") for kind, n in count.items()],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
