"""op1: all pages written to WARC archives and read back."""

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.warc import round_trip


def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p
"""

QUERIES = {"op1_archived_pages": (archived_pages, SQL)}
