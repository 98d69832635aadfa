"""op12: the prefixes that rebuilt conversations share."""

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.prefix_trie import rebuilt_trie


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# h comes from CRC-32 with the reflected polynomial EDB88320 (3988292384), bit by bit.
SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS p,
    coalesce(role, '') AS role, coalesce(text, '') AS body
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),
crc AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(s) + 1),
      lambda i: ascii(substr(s, i, 1))::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
    4294967295::BIGINT) % 4 AS h
  FROM ids),
r AS (
  SELECT crc.c, p AS place, role, body FROM crc JOIN t ON t.c = crc.c - crc.c % 20 WHERE p < h
  UNION ALL SELECT t.c, p, role, body FROM t JOIN crc USING (c) WHERE p >= h),
q AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY place) AS d, struct_pack(role := role, body := body) AS u,
    len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS w FROM r),
paths AS (
  SELECT c, 0 AS d, CAST([] AS STRUCT(role VARCHAR, body VARCHAR)[]) AS path, 0 AS w FROM crc
  UNION ALL SELECT c, d, list(u) OVER (PARTITION BY c ORDER BY d), w FROM q),
ends AS (SELECT path, c FROM paths QUALIFY d = max(d) OVER (PARTITION BY c)),
n AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, max(w) AS w FROM paths GROUP BY path, d),
kids AS (
  SELECT m.path[1:m.d - 1] AS path, count(*) AS n_children FROM n m WHERE m.d > 0 GROUP BY 1),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)),
below AS (
  SELECT a.path, sum((k.n_convs - 1) * k.w) AS saved, count(*) FILTER (k.n_children = 0) AS leaves
  FROM k JOIN paths a ON a.c = k.conv_id AND a.d <= k.d GROUP BY 1),
ended AS (SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS listed FROM ends GROUP BY 1)
SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(listed, '')) AS ends_sha256
FROM k JOIN below USING (path) LEFT JOIN ended USING (path)
LEFT JOIN k up ON k.d > 0 AND up.path = k.path[1:k.d - 1]
"""

QUERIES = {"op12_conversation_prefixes": (conversation_prefixes, SQL)}
