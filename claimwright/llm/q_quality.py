"""op10: quality measures of every document and the verdict of line-first cleaning."""

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.quality import quality


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
rep AS (
  SELECT r, count(DISTINCT pos) AS n FROM (
    SELECT r, unnest(range(i, i + 5)) AS pos
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c >= 2) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    len(regexp_extract_all(line, '[|»›•]')) AS separators,
    len(regexp_extract_all(line, '[#*$%&<>]')) AS symbols,
    len(regexp_extract_all(line, '[!?]{2,}([\x20\x09-\x0D]|$)')) AS shouts,
    regexp_matches(line, '(?i)\b(cookies?|privacy policy|terms of (use|service)|all rights reserved|javascript|subscribe|sign (in|up)|log ?in|newsletter|click here|read more|share (on|this)|lorem ipsum|copyright)\b') AS phrase,
    regexp_matches(line, '[.!?:;,)\]}"''][\x20\x09-\x0D]*$')
      OR (regexp_matches(line, '[\p{Po}\p{Pe}\p{Pf}][\x20\x09-\x0D]*$')
        AND regexp_matches(line, '[^\x00-\x7F][\x20\x09-\x0D]*$')) AS closed,
    NOT regexp_matches(line, '[A-Za-z]') AND len(regexp_extract_all(line, '[\p{L}\p{M}]')) >= 10 AS unspaced,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM l),
f AS (
  SELECT *, CASE WHEN words = 0 THEN '' WHEN separators >= 3 AND words <= 4 * (separators + 1) THEN 'n'
    WHEN words <= 30 AND phrase THEN 'b'
    WHEN (symbols >= 3 AND 10 * symbols > words) OR (shouts >= 2 AND 5 * shouts >= words)
      OR (words < 3 AND NOT closed AND NOT unspaced) THEN 'p' ELSE '' END AS rule FROM m),
c AS (
  SELECT r, sum(chars)::BIGINT AS word_chars, sum(words)::BIGINT AS n_words,
    (count(*) FILTER (words > 0))::BIGINT AS n_lines,
    (count(*) FILTER (words > 0) - count(DISTINCT line) FILTER (words > 0))::BIGINT AS n_dup_lines,
    (count(*) FILTER (rule = 'n'))::BIGINT AS n_navigation,
    (count(*) FILTER (rule = 'b'))::BIGINT AS n_boilerplate,
    (count(*) FILTER (rule = 'p'))::BIGINT AS n_punctuation,
    coalesce(sum(chars) FILTER (rule <> ''), 0)::BIGINT AS lost_chars
  FROM f GROUP BY r),
a AS (
  SELECT d.r, doc_id, c.*, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN c USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_navigation,
  n_boilerplate, n_punctuation, lost_chars,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM a
"""

QUERIES = {"op10_document_quality": (document_quality, SQL)}
