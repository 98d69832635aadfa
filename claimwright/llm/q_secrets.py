"""op7: secrets in every document."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.secrets import KINDS, listed, secrets


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")


def document_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )



_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_RUNS = "[A-Za-z0-9+/_=-]{20,}"
_ASSIGN_SQL = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _hits_sql(kind: int, pattern: str, fits: str = "true") -> str:
    """Spans of a pattern's matches: texts between matches and matches alternate."""
    return f"""
  SELECT r, {kind} AS kind, hit, s::BIGINT AS s, (s + length(hit))::BIGINT AS e FROM (
    SELECT r, hits[i] AS hit, groups[i] AS g,
      list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (
      SELECT r, hits, gaps, groups, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT r, regexp_extract_all(text, '{pattern}') AS hits,
          string_split_regex(text, '{pattern}') AS gaps,
          regexp_extract_all(text, '{pattern}', {2 if kind == 0 else 0}) AS groups FROM d)))
  WHERE {fits}"""


def _two_sided(z: str) -> str:
    return f"least(1e0, 2 * {_upper(f'abs({z})')})"


def _upper(z: str) -> str:
    return f"1 / (1 + exp(least(60e0, 1.5976e0 * ({z}) + 0.070565992e0 * ({z}) * ({z}) * ({z}))))"


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_hits_sql(0, _ASSIGN_SQL, "length(g) >= 6")}
  UNION ALL {_hits_sql(1, "AKIA[A-Z0-9]+", "length(hit) >= 20")}
  UNION ALL {_hits_sql(2, "[0-9a-f]+", "length(hit) >= 24")}),
tokens AS (
  SELECT *, rtrim(hit, '=') AS body, CASE
    WHEN NOT regexp_matches(hit, '[0-9]') THEN NULL
    WHEN regexp_matches(hit, '^[0-9a-f]+$') AND regexp_matches(hit, '[a-z]') THEN 'hex'
    WHEN regexp_matches(hit, '^[0-9A-F]+$') AND regexp_matches(hit, '[A-Z]') THEN 'HEX'
    WHEN regexp_matches(hit, '^[0-9a-z]+$') AND regexp_matches(hit, '[a-z]') THEN 'lower'
    WHEN regexp_matches(hit, '^[0-9A-Z]+$') AND regexp_matches(hit, '[A-Z]') THEN 'upper'
    WHEN regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')
      AND regexp_matches(hit, '^[^=]+=*$') THEN 'base64' END AS encoding
  FROM ({_hits_sql(3, _RUNS)}) t
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = t.r AND b.s < t.e AND t.s < b.e)),
coded AS (
  SELECT *, length(body) AS n, length(alphabet) AS size, greatest(2, least(length(alphabet), length(body) // 5)) AS cells,
    list_transform(range(1, length(body) + 1), lambda i: strpos(alphabet, substr(body, i, 1)) - 1) AS codes
  FROM (SELECT *, CASE encoding WHEN 'hex' THEN '{_DIGITS}{_LOWER[:6]}'
      WHEN 'HEX' THEN '{_DIGITS}{_LOWER[:6].upper()}' WHEN 'lower' THEN '{_DIGITS}{_LOWER}'
      WHEN 'upper' THEN '{_DIGITS}{_LOWER.upper()}'
      ELSE '{_LOWER.upper()}{_LOWER}{_DIGITS}+/-_' END AS alphabet
    FROM tokens WHERE encoding IS NOT NULL)),
sums AS (
  SELECT *, list_sum(codes)::DOUBLE / n AS mean,
    len(list_filter(codes, lambda x: 2 * x >= size))::DOUBLE AS ones,
    1 + list_sum(list_transform(range(1, n), lambda i:
      CASE WHEN (2 * codes[i] >= size) <> (2 * codes[i + 1] >= size) THEN 1 ELSE 0 END)) AS runs,
    list_sum(list_transform(range(0, cells), lambda c:
      pow(len(list_filter(codes, lambda x: x * cells // size = c))
        - n * (((c + 1) * size + cells - 1) // cells - (c * size + cells - 1) // cells)::DOUBLE / size, 2)
      / (n * (((c + 1) * size + cells - 1) // cells - (c * size + cells - 1) // cells)::DOUBLE / size))) AS chi
  FROM coded),
tests AS (
  SELECT *, n - ones AS zeros, 2 * ones * (n - ones) AS both_sides, 2e0 / (9e0 * (cells - 1)) AS spread,
    list_sum(list_transform(codes, lambda x: (x - mean) * (x - mean))) AS square,
    list_sum(list_transform(range(1, n), lambda i: (codes[i] - mean) * (codes[i + 1] - mean))) AS shared
  FROM sums),
judged AS (
  SELECT *, least(1e0, 3 * least(
    {_upper("(cbrt(chi / (cells - 1)) - (1 - spread)) / sqrt(spread)")},
    CASE WHEN ones = 0 OR zeros = 0 THEN 0e0 ELSE {_two_sided(
        "(runs - both_sides / n - 1) / sqrt(greatest(both_sides * (both_sides - n) / (n::DOUBLE * n * (n - 1)), 1e-9))"
    )} END,
    CASE WHEN square = 0 THEN 0e0 ELSE {_two_sided(
        "(shared / greatest(square, 1e-9) + 1e0 / n) * sqrt(n)"
    )} END)) AS p,
    concat(encoding, ':', CAST(floor(log2(length(hit)) * 2) AS BIGINT)) AS stratum
  FROM tests),
binned AS (
  SELECT *, least(96, CAST(floor(-log10(greatest(p, 1e-30)) * 8) AS BIGINT)) AS bin FROM judged),
bounds AS (
  SELECT stratum, min(bin) AS lowest FROM (
    SELECT stratum, bin, sum(count(*)) OVER (PARTITION BY stratum) AS total,
      sum(count(*)) OVER (PARTITION BY stratum ORDER BY bin DESC) AS seen
    FROM binned GROUP BY stratum, bin)
  WHERE total * pow(10e0, -bin / 8e0) <= 0.05e0 * seen GROUP BY stratum),
spans AS (
  SELECT r, kind, s, e FROM base UNION ALL
  SELECT r, kind, s, e FROM binned LEFT JOIN bounds USING (stratum) WHERE bin < coalesce(lowest, 1000)),
named AS (
  SELECT r, kind, s, concat(['assign', 'access', 'hex', 'random'][kind + 1], ':', s, ':', e) AS span FROM spans),
listed AS (
  SELECT r, (count(*) FILTER (kind = 0))::BIGINT AS n_assign, (count(*) FILTER (kind = 1))::BIGINT AS n_access,
    (count(*) FILTER (kind = 2))::BIGINT AS n_hex,
    string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
    string_agg(span, ',' ORDER BY s, kind) AS spans
  FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""

QUERIES = {"op7_document_secrets": (document_secrets, SQL)}
