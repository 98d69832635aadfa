"""op4: the words each document gives to a mix of all sources, and its positions in the run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.mixing import plan


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents range-sorted by the position of their first reading; those never read come last, by a hash."""
    planned = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return planned.select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.try_element_at("positions", F.lit(1)).alias("first_position"),
        F.try_element_at("positions", F.lit(-1)).alias("last_position"),
    ).orderBy(F.col("first_position").asc_nulls_last(), F.xxhash64("doc_id", "size"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    sha256(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    3 * source_size AS most FROM s),
o AS (
  SELECT *,
    (sum(source_size) OVER ())::BIGINT - coalesce(sum(most) OVER before, 0)::BIGINT AS rest,
    (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS share
  FROM w WINDOW before AS (
    ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, rest::DOUBLE / share::DOUBLE AS level FROM o),
t AS (
  SELECT source, source_size, weight,
    least(most::DOUBLE, weight * (SELECT level FROM v WHERE level * weight <= most
      ORDER BY most::DOUBLE / weight::DOUBLE, source NULLS LAST LIMIT 1)) AS target
  FROM v),
p AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
m AS (
  SELECT p.doc_id, p.size, t.source_size, t.target,
    list_filter([2 * start + size, 2 * (t.source_size + start) + size, 2 * (2 * t.source_size + start) + size],
      lambda twice: size > 0 AND twice <= 2 * target) AS middles,
    CASE weight WHEN 1 THEN 1.5e0 WHEN 2 THEN 1e0 ELSE 0.5e0 END AS a,
    CASE weight WHEN 1 THEN -1e0 WHEN 2 THEN 0e0 ELSE 1e0 END AS slope
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
u AS (
  SELECT *, middles[1]::DOUBLE / (2 * target) AS first_used, middles[-1]::DOUBLE / (2 * target) AS last_used
  FROM m)
SELECT doc_id, size, source_size, target, (size * len(middles))::BIGINT AS taken,
  2 * first_used / (a + sqrt(a * a + 2 * slope * first_used)) AS first_position,
  2 * last_used / (a + sqrt(a * a + 2 * slope * last_used)) AS last_position
FROM u
"""

QUERIES = {"op4_mixed_documents": (mixed_documents, SQL)}
