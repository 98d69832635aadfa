"""op11: the strongest phrases of each language."""

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.collocations import collocations


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, s, w[i:i + s - 1] AS gram, count(*) AS f
  FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM w, range(1, 5) AS sizes(s))
  GROUP BY 1, 2, 3),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE s = 1 GROUP BY 1),
c AS (SELECT lang, s, gram, f AS a FROM g WHERE s >= 2 AND f >= 30),
inside AS (
  SELECT lang, gram[j:j + t - 1] AS gram, max(a) AS most
  FROM (SELECT *, unnest(range(1, s - t + 2)) AS j FROM c, range(2, 4) AS parts(t) WHERE t < s) GROUP BY 1, 2),
cuts AS (
  SELECT c.lang, c.gram, c.a, k, x.f AS l, y.f AS r,
    CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, s)) AS k FROM c) c
  JOIN g x ON x.lang = c.lang AND x.gram = c.gram[1:k] JOIN g y ON y.lang = c.lang AND y.gram = c.gram[k + 1:c.s]
  LEFT JOIN inside i ON i.lang = c.lang AND i.gram = c.gram
  WHERE coalesce(100::HUGEINT * i.most < 80::HUGEINT * c.a, true)),
best AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best JOIN total USING (lang)
QUALIFY rank <= 2000
"""

QUERIES = {"op11_phrase_collocations": (phrase_collocations, SQL)}
