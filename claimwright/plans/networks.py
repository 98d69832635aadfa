"""Provider groups and sets of codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.functions import half_up
from claimwright.operators import communities, itemsets
from claimwright.plans import tables as t
from claimwright.session import settle
from claimwright.sources import derived

MIN_CLAIMS = 4
SUPPORT, CONFIDENCE, MOST = 0.05, 0.6, 3
RARE_SUPPORT, RATIO = 0.001, 0.97


def provider_groups(spark, sf_dir):
    claims = derived.medical_claims(spark, sf_dir).select("patient_id", "provider_id")
    return communities.provider_groups(claims, MIN_CLAIMS)


def _baskets(spark, sf_dir):
    claims = derived.medical_claims(spark, sf_dir)
    return itemsets.baskets(claims.select("patient_id", "service_date", *itemsets.ITEM_COLUMNS))


def code_sets(spark, sf_dir):
    model = itemsets.fit(_baskets(spark, sf_dir), SUPPORT)
    return itemsets.frequent_sets(model, MOST).select(F.concat_ws("+", "items").alias("codes"), "baskets")


def code_rules(spark, sf_dir):
    model = itemsets.fit(_baskets(spark, sf_dir), SUPPORT, CONFIDENCE)
    return itemsets.code_rules(model, MOST).select(
        F.concat_ws("+", "antecedent").alias("antecedent"),
        "consequent",
        half_up(F.col("confidence"), 9).alias("confidence"),
        half_up(F.col("lift"), 9).alias("lift"),
    )


def unusual_code_sets(spark, sf_dir):
    stored = settle(_baskets(spark, sf_dir), "year-baskets")
    sets = itemsets.frequent_sets(itemsets.fit(stored, RARE_SUPPORT), 2)
    return itemsets.unusual_sets(sets, stored.count(), RATIO).select(
        F.concat_ws("+", "items").alias("codes"), "baskets", half_up(F.col("ratio"), 9).alias("ratio")
    )


_ITEMS = (
    "SELECT DISTINCT patient_id AS p, year(service_date) AS y, unnest([primary_diagnosis_code, "
    "procedure_code]) AS item FROM mc0"
)
_COUNTS = (
    f"i AS ({_ITEMS}), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT DISTINCT p, y FROM i)), "
    "c AS (SELECT item AS codes, 1 AS size, item AS last, [item] AS items, count(*) AS baskets FROM i GROUP BY ALL "
    "UNION ALL SELECT a.item || '+' || b.item, 2, b.item, [a.item, b.item], count(*) FROM i a JOIN i b "
    "ON a.p = b.p AND a.y = b.y AND a.item < b.item GROUP BY ALL "
    "UNION ALL SELECT a.item || '+' || b.item || '+' || c.item, 3, c.item, [a.item, b.item, c.item], count(*) "
    "FROM i a JOIN i b ON a.p = b.p AND a.y = b.y AND a.item < b.item "
    "JOIN i c ON a.p = c.p AND a.y = c.y AND b.item < c.item GROUP BY ALL)"
)

QUERIES = {
    "provider_groups": (
        provider_groups,
        t.over(
            "mc0",
            "SELECT * FROM (WITH RECURSIVE e AS (SELECT patient_id AS p, provider_id AS q, count(*) AS n FROM mc0 "
            f"GROUP BY ALL HAVING count(*) >= {MIN_CLAIMS}), "
            "l AS (SELECT DISTINCT a.q AS a, b.q AS b FROM e a JOIN e b USING (p)), "
            "r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), "
            "g AS (SELECT a AS provider, min(b) AS group_id FROM r GROUP BY a) "
            "SELECT provider, group_id, providers, patients, claims FROM g JOIN (SELECT group_id, "
            "count(DISTINCT q) AS providers, count(DISTINCT p) AS patients, CAST(sum(n) AS BIGINT) AS claims "
            "FROM e JOIN g ON q = provider GROUP BY 1) USING (group_id))",
        ),
    ),
    "code_sets": (
        code_sets,
        t.over(
            "mc0",
            f"SELECT * FROM (WITH {_COUNTS} SELECT codes, baskets FROM c, n WHERE baskets >= ceil({SUPPORT} * n))",
        ),
    ),
    "code_rules": (
        code_rules,
        t.over(
            "mc0",
            f"SELECT * FROM (WITH {_COUNTS}, u AS (SELECT items, size, baskets, unnest(items) AS consequent FROM c "
            f"WHERE size > 1 AND baskets >= ceil({SUPPORT} * (SELECT n FROM n))), "
            "w AS (SELECT *, array_to_string(list_filter(items, lambda x: x <> consequent), '+') AS antecedent FROM u) "
            f"SELECT antecedent, w.consequent, {t.half_up('w.baskets / CAST(a.baskets AS DOUBLE)', 9)} AS confidence, "
            f"{t.half_up('w.baskets / CAST(a.baskets AS DOUBLE) / (s.baskets / n)', 9)} AS lift "
            "FROM w JOIN c a ON a.codes = antecedent JOIN c s ON s.codes = w.consequent, n "
            f"WHERE w.baskets / CAST(a.baskets AS DOUBLE) >= {CONFIDENCE})",
        ),
    ),
    "unusual_code_sets": (
        unusual_code_sets,
        t.over(
            "mc0",
            f"SELECT * FROM (WITH {_COUNTS}, k AS (SELECT c.codes, c.baskets, "
            "c.baskets / (a.baskets / n * (b.baskets / n) * n) AS ratio FROM c JOIN c a ON a.codes = c.items[1] "
            f"JOIN c b ON b.codes = c.items[2], n WHERE c.size = 2 AND c.baskets >= ceil({RARE_SUPPORT} * n)) "
            f"SELECT codes, baskets, {t.half_up('ratio', 9)} AS ratio FROM k WHERE ratio <= {RATIO})",
        ),
    ),
}
