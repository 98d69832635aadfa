"""op5: benchmark words in every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.decontaminate import contamination


def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, words, least(13, len(words))::BIGINT AS width FROM b WHERE len(words) > 0),
g AS (
  SELECT DISTINCT item_id, width, array_to_string(words[i:i + width - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS i FROM bw)),
dg AS (
  SELECT r, i, width, array_to_string(words[i:i + width - 1], ' ') AS gram
  FROM (
    SELECT r, words, width, unnest(range(1, len(words) - width + 2)) AS i
    FROM d, (SELECT DISTINCT width FROM g) WHERE len(words) >= width)),
o AS (SELECT r, i, width, item_id FROM dg JOIN g USING (width, gram)),
h AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS pos FROM o) GROUP BY r),
t AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
  FROM o GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

QUERIES = {"op5_contaminated_documents": (contaminated_documents, SQL)}
