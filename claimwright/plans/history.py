"""History features of patients, providers and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.functions import half_up
from claimwright.operators import history
from claimwright.operators.training import COMPLEX_DIAGNOSES
from claimwright.plans import screening
from claimwright.plans import tables as t
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"
_DAY = "CAST(service_date AS DATE)"


def _claims(spark, sf_dir):
    return derived.medical_claims(spark, sf_dir)


def days_since_last_claim(spark, sf_dir):
    claims = _claims(spark, sf_dir).select(*ROW_KEYS, "patient_id", "service_date")
    return history.days_since_last_claim(claims).select(*ROW_KEYS, "days_since_last_claim")


def provider_monthly_trend(spark, sf_dir):
    return history.provider_monthly_trend(_claims(spark, sf_dir))


def diagnosis_seasonality(spark, sf_dir):
    return history.diagnosis_seasonality(_claims(spark, sf_dir))


def provider_history_rate(spark, sf_dir):
    claims = screening.labelled(spark, sf_dir).select(
        *ROW_KEYS, "provider_id", "service_date", "is_rejected"
    )
    return history.with_provider_history(claims).select(
        *ROW_KEYS, "earlier_claims", "earlier_rejection_rate"
    )


def peer_deviation(spark, sf_dir):
    return history.peer_deviation(screening.labelled(spark, sf_dir))


def billing_consistency(spark, sf_dir):
    return history.billing_consistency(_claims(spark, sf_dir)).withColumn(
        "variation", half_up(F.col("variation"), 6)
    )


def provider_network(spark, sf_dir):
    return history.provider_network(_claims(spark, sf_dir))


def claim_frequency(spark, sf_dir):
    return history.claim_frequency(_claims(spark, sf_dir))


def amount_trend(spark, sf_dir):
    return history.amount_trend(_claims(spark, sf_dir))


def geographic_movement(spark, sf_dir):
    """Moves between the states of the providers a patient sees."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr(
        "s_suppkey AS sk", "lpad(CAST(s_nationkey AS STRING), 2, '0') AS place"
    )
    claims = _claims(spark, sf_dir).select("patient_id", "service_date", "sk").join(suppliers, "sk")
    return history.geographic_movement(claims, "place")


def dx_px_lift(spark, sf_dir):
    return history.code_lift(_claims(spark, sf_dir))


def diagnosis_complexity(spark, sf_dir):
    return history.diagnosis_complexity(_claims(spark, sf_dir), COMPLEX_DIAGNOSES)


def procedure_age_band(spark, sf_dir):
    claims = _claims(spark, sf_dir).select(*ROW_KEYS, "procedure_code", "patient_age")
    return history.with_age_band(claims).select(*ROW_KEYS, "age_low", "age_high", "age_unusual")


def amount_norms(spark, sf_dir):
    claims = _claims(spark, sf_dir).select(
        *ROW_KEYS, "primary_diagnosis_code", "procedure_code", "billed_amount"
    )
    return history.with_amount_norms(claims).select(
        *ROW_KEYS, half_up(F.col("diagnosis_zscore"), 6).alias("diagnosis_zscore"), "market_ratio"
    )


_COMBINATION = ["primary_diagnosis_code", "procedure_code", "provider_specialty"]


def rare_combinations(spark, sf_dir):
    return history.rare_combinations(_claims(spark, sf_dir), _COMBINATION, 0.0025)


def cost_escalation(spark, sf_dir):
    return history.cost_escalation(_claims(spark, sf_dir))


def submission_urgency(spark, sf_dir):
    return history.urgency(screening.labelled(spark, sf_dir))


_X = f"date_diff('day', DATE '1970-01-01', {_DAY})"
_Y = "CAST(floor(billed_amount * 1e4 + 0.5e0) AS BIGINT)"
_CHRONIC = "primary_diagnosis_code IN ('E11.9', 'I10', 'J44.1')"

QUERIES = {
    "days_since_last_claim": (
        days_since_last_claim,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, gap AS days_since_last_claim FROM mc0 JOIN (SELECT patient_id AS p, d, "
            "CAST(date_diff('day', lag(d) OVER (PARTITION BY patient_id ORDER BY d), d) AS INT) "
            f"AS gap FROM (SELECT DISTINCT patient_id, {_DAY} AS d FROM mc0)) "
            f"ON patient_id = p AND {_DAY} = d",
        ),
    ),
    "provider_monthly_trend": (
        provider_monthly_trend,
        t.over(
            "mc0",
            "SELECT provider_id, month, claims, claims - lag(claims) OVER w AS change, "
            "avg(claims) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three_month_mean "
            "FROM (SELECT provider_id, CAST(date_trunc('month', service_date) AS DATE) AS month, "
            "count(*) AS claims FROM mc0 GROUP BY 1, 2) "
            "WINDOW w AS (PARTITION BY provider_id ORDER BY month)",
        ),
    ),
    "diagnosis_seasonality": (
        diagnosis_seasonality,
        t.over(
            "mc0",
            "SELECT primary_diagnosis_code, month, claims, CAST(claims AS DOUBLE) / "
            "CAST(sum(claims) OVER (PARTITION BY primary_diagnosis_code) AS DOUBLE) AS share "
            "FROM (SELECT primary_diagnosis_code, month(service_date) AS month, "
            "count(*) AS claims FROM mc0 GROUP BY 1, 2)",
        ),
    ),
    "provider_history_rate": (
        provider_history_rate,
        t.over(
            "mc",
            f"SELECT {_KEYS}, CAST(coalesce(n, 0) AS BIGINT) AS earlier_claims, "
            "CAST(r AS DOUBLE) / CAST(n AS DOUBLE) AS earlier_rejection_rate FROM "
            "(SELECT *, count(*) OVER w AS n0, nullif(count(*) OVER w, 0) AS n, "
            "sum(CAST(is_rejected AS INT)) OVER w AS r FROM mc WINDOW w AS "
            f"(PARTITION BY provider_id ORDER BY {_DAY} RANGE BETWEEN UNBOUNDED PRECEDING "
            "AND INTERVAL 1 DAY PRECEDING))",
        ),
    ),
    "peer_deviation": (
        peer_deviation,
        t.over(
            "mc",
            "SELECT provider_id, provider_specialty, claims, r AS rejection_rate, "
            "r - peer AS deviation FROM (SELECT provider_id, provider_specialty, "
            "count(*) AS claims, CAST(sum(CAST(is_rejected AS INT)) AS DOUBLE) / count(*) AS r "
            "FROM mc GROUP BY 1, 2) JOIN (SELECT provider_specialty AS ps, "
            "CAST(sum(CAST(is_rejected AS INT)) AS DOUBLE) / count(*) AS peer FROM mc GROUP BY 1) "
            "ON provider_specialty = ps",
        ),
    ),
    "billing_consistency": (
        billing_consistency,
        t.over(
            "mc0",
            f"SELECT provider_id, count(*) AS claims, {t.exact_mean('billed_amount')} "
            f"AS mean_amount, {t.half_up('stddev_samp(billed_amount) / avg(billed_amount)', 6)} "
            "AS variation FROM mc0 GROUP BY 1",
        ),
    ),
    "provider_network": (
        provider_network,
        t.over(
            "mc0",
            "SELECT provider_id, count(*) AS patients, "
            f"{t.count_if('n > 1')} AS shared_patients, CAST(sum(n - 1) AS BIGINT) AS links FROM "
            "(SELECT DISTINCT patient_id, provider_id FROM mc0) JOIN "
            "(SELECT patient_id AS p, count(DISTINCT provider_id) AS n FROM mc0 GROUP BY 1) "
            "ON patient_id = p GROUP BY 1",
        ),
    ),
    "claim_frequency": (
        claim_frequency,
        t.over(
            "mc0",
            "SELECT patient_id, day, claims, CAST(sum(claims) OVER (PARTITION BY patient_id "
            "ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW) AS BIGINT) "
            f"AS recent_claims FROM (SELECT patient_id, {_DAY} AS day, count(*) AS claims "
            "FROM mc0 GROUP BY 1, 2)",
        ),
    ),
    "amount_trend": (
        amount_trend,
        t.over(
            "mc0",
            "SELECT patient_id, claims, CASE WHEN claims * sxx - sx * sx > 0 THEN "
            "(claims * sxy - sx * sy) / (claims * sxx - sx * sx) / 1e4 END AS slope FROM "
            f"(SELECT patient_id, count(*) AS claims, CAST(sum({_X}) AS DOUBLE) AS sx, "
            f"CAST(sum({_Y}) AS DOUBLE) AS sy, CAST(sum({_X} * {_X}) AS DOUBLE) AS sxx, "
            f"CAST(sum({_X} * {_Y}) AS DOUBLE) AS sxy FROM mc0 GROUP BY 1)",
        ),
    ),
    "geographic_movement": (
        geographic_movement,
        t.over(
            "mc0",
            "SELECT patient_id, count(*) AS claim_days, "
            f"{t.count_if('f <> prev')} AS moves FROM (SELECT patient_id, f, "
            "lag(l) OVER (PARTITION BY patient_id ORDER BY d) AS prev FROM (SELECT patient_id, "
            f"{_DAY} AS d, min(lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS f, "
            "max(lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS l FROM mc0 "
            "JOIN supplier ON sk = s_suppkey GROUP BY 1, 2)) GROUP BY 1",
        ),
    ),
    "dx_px_lift": (
        dx_px_lift,
        t.over(
            "mc0",
            "SELECT primary_diagnosis_code, procedure_code, n AS claims, CAST(n AS DOUBLE) * "
            "CAST(sum(n) OVER () AS DOUBLE) / (CAST(sum(n) OVER (PARTITION BY "
            "primary_diagnosis_code) AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY procedure_code) "
            "AS DOUBLE)) AS lift FROM (SELECT primary_diagnosis_code, procedure_code, "
            "count(*) AS n FROM mc0 GROUP BY 1, 2)",
        ),
    ),
    "diagnosis_complexity": (
        diagnosis_complexity,
        t.over(
            "mc0",
            "SELECT patient_id, count(DISTINCT primary_diagnosis_code) AS diagnoses, "
            "count(DISTINCT left(primary_diagnosis_code, 1)) AS chapters, "
            f"count(DISTINCT CASE WHEN {_CHRONIC} THEN primary_diagnosis_code END) "
            f"AS chronic_conditions, count(DISTINCT CASE WHEN {_CHRONIC} THEN "
            "primary_diagnosis_code END) > 1 AS comorbid FROM mc0 GROUP BY 1",
        ),
    ),
    "procedure_age_band": (
        procedure_age_band,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, age_low, age_high, patient_age < age_low OR patient_age > age_high "
            "AS age_unusual FROM mc0 JOIN (SELECT procedure_code AS pc, "
            "quantile_cont(CAST(patient_age AS DOUBLE), 0.05) AS age_low, "
            "quantile_cont(CAST(patient_age AS DOUBLE), 0.95) AS age_high FROM mc0 GROUP BY 1) "
            "ON procedure_code = pc",
        ),
    ),
    "amount_norms": (
        amount_norms,
        t.over(
            "mc0",
            f"SELECT {_KEYS}, {t.half_up('(billed_amount - m) / d', 6)} AS diagnosis_zscore, "
            "billed_amount / market AS market_ratio FROM mc0 JOIN (SELECT primary_diagnosis_code "
            "AS dc, avg(billed_amount) AS m, stddev_samp(billed_amount) AS d FROM mc0 GROUP BY 1) "
            "ON primary_diagnosis_code = dc JOIN (SELECT procedure_code AS pc, "
            f"{t.exact_mean('billed_amount')} AS market FROM mc0 GROUP BY 1) "
            "ON procedure_code = pc",
        ),
    ),
    "rare_combinations": (
        rare_combinations,
        t.over(
            "mc0",
            f"SELECT {', '.join(_COMBINATION)}, n AS claims, share FROM (SELECT *, "
            "CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM (SELECT "
            f"{', '.join(_COMBINATION)}, count(*) AS n FROM mc0 GROUP BY ALL)) "
            "WHERE share < 0.0025e0",
        ),
    ),
    "cost_escalation": (
        cost_escalation,
        t.over(
            "mc0",
            "SELECT patient_id, day, m AS mean_amount, m - lag(m) OVER (PARTITION BY patient_id "
            f"ORDER BY day) AS change FROM (SELECT patient_id, {_DAY} AS day, "
            f"{t.exact_mean('billed_amount')} AS m FROM mc0 GROUP BY 1, 2)",
        ),
    ),
    "submission_urgency": (
        submission_urgency,
        t.over(
            "mc",
            "SELECT CASE WHEN days_to_submission <= 7 THEN 'week' WHEN days_to_submission <= 30 "
            "THEN 'month' WHEN days_to_submission <= 60 THEN 'two months' ELSE 'later' END "
            f"AS urgency, count(*) AS claims, {t.flag_mean('is_rejected')} AS rejection_rate, "
            f"{t.exact_sum('billed_amount')} AS billed FROM mc GROUP BY 1",
        ),
    ),
}
