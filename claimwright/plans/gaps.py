"""Operators over claims with NaN amounts and without codes, providers or patients."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.functions import half_up
from claimwright.operators import history, quality
from claimwright.operators import statistics as stats
from claimwright.plans import screening
from claimwright.plans import tables as t
from claimwright.session import settle
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS

_KEYS = "ok, ln, pk, sk"
_MISSING = {
    "primary_diagnosis_code": "CASE WHEN pk % 59 <> 0 THEN primary_diagnosis_code END",
    "procedure_code": "CASE WHEN pk % 61 <> 0 THEN procedure_code END",
    "provider_id": "CASE WHEN sk % 3 <> 0 THEN provider_id END",
}
_AMOUNT = "CASE WHEN pk % 53 = 0 THEN {} ELSE billed_amount END"


def _gapped(spark, sf_dir):
    """Claims in which unknown amounts are NaN, as files hold them."""
    gaps = _MISSING | {"billed_amount": _AMOUNT.format("CAST('NaN' AS DOUBLE)")}
    claims = derived.medical_claims(spark, sf_dir)
    return claims.withColumns({name: F.expr(text) for name, text in gaps.items()})


# The SQL side has nulls where the claims have NaN: both are to count as unknown.
_GAPPED_SQL = (
    t.over("mc0", "")
    + ", g AS (SELECT * REPLACE ("
    + ", ".join(
        f"{text} AS {name}"
        for name, text in (_MISSING | {"billed_amount": _AMOUNT.format("NULL")}).items()
    )
    + ") FROM mc0) "
)


def gap_zscore(spark, sf_dir):
    claims = _gapped(spark, sf_dir).select(*ROW_KEYS, "provider_specialty", "billed_amount")
    claims = claims.withColumn("is_rejected", F.lit(False))
    scored = stats.with_zscore(claims, settle(stats.claim_baselines(claims), "baselines"))
    return scored.select(
        *ROW_KEYS, half_up(F.col("billed_amount_zscore"), 6).alias("billed_amount_zscore")
    )


def gap_amount_norms(spark, sf_dir):
    return history.with_amount_norms(_gapped(spark, sf_dir)).select(
        *ROW_KEYS, half_up(F.col("diagnosis_zscore"), 6).alias("diagnosis_zscore"), "market_ratio"
    )


def gap_consistency(spark, sf_dir):
    return history.billing_consistency(_gapped(spark, sf_dir)).withColumn(
        "variation", half_up(F.col("variation"), 6)
    )


def gap_lift(spark, sf_dir):
    return history.code_lift(_gapped(spark, sf_dir))


def gap_duplicates(spark, sf_dir):
    keys = ["provider_id", "primary_diagnosis_code", "service_date"]
    claims = _gapped(spark, sf_dir).select(*ROW_KEYS, *keys)
    return quality.duplicate_claims(claims, keys, ROW_KEYS)


def gap_provider_history(spark, sf_dir):
    claims = screening.labelled(spark, sf_dir).select(
        *ROW_KEYS, "provider_id", "service_date", "is_rejected"
    )
    claims = claims.withColumn("provider_id", F.expr(_MISSING["provider_id"]))
    return history.with_provider_history(claims).select(
        *ROW_KEYS, "earlier_claims", "earlier_rejection_rate"
    )


def gap_age_band(spark, sf_dir):
    return history.with_age_band(_gapped(spark, sf_dir)).select(
        *ROW_KEYS, "age_low", "age_high", "age_unusual"
    )


def procedure_gender(spark, sf_dir):
    """Gender per procedure; half of the claims is the bound, so that the rule fires here."""
    return history.with_gender_share(_gapped(spark, sf_dir), unusual_below=0.5).select(
        *ROW_KEYS, "gender_share", "gender_unusual"
    )


_DAY = "CAST(service_date AS DATE)"

QUERIES = {
    "gap_zscore": (
        gap_zscore,
        _GAPPED_SQL
        + f"SELECT {_KEYS}, {t.half_up('(billed_amount - m) / d', 6)} AS billed_amount_zscore "
        "FROM g, (SELECT avg(billed_amount) AS m, stddev_samp(billed_amount) AS d FROM g)",
    ),
    "gap_amount_norms": (
        gap_amount_norms,
        _GAPPED_SQL
        + f"SELECT {_KEYS}, {t.half_up('(billed_amount - m) / d', 6)} AS diagnosis_zscore, "
        "billed_amount / market AS market_ratio FROM g JOIN (SELECT primary_diagnosis_code AS dc, "
        "avg(billed_amount) AS m, stddev_samp(billed_amount) AS d FROM g GROUP BY 1) "
        "ON primary_diagnosis_code IS NOT DISTINCT FROM dc JOIN (SELECT procedure_code AS pc, "
        f"{t.exact_mean('billed_amount')} AS market FROM g GROUP BY 1) "
        "ON procedure_code IS NOT DISTINCT FROM pc",
    ),
    "gap_consistency": (
        gap_consistency,
        _GAPPED_SQL
        + f"SELECT provider_id, count(*) AS claims, {t.exact_mean('billed_amount')} "
        f"AS mean_amount, {t.half_up('stddev_samp(billed_amount) / avg(billed_amount)', 6)} "
        "AS variation FROM g GROUP BY 1",
    ),
    "gap_lift": (
        gap_lift,
        _GAPPED_SQL
        + "SELECT primary_diagnosis_code, procedure_code, n AS claims, CAST(n AS DOUBLE) * "
        "CAST(sum(n) OVER () AS DOUBLE) / (CAST(sum(n) OVER (PARTITION BY "
        "primary_diagnosis_code) AS DOUBLE) * CAST(sum(n) OVER (PARTITION BY procedure_code) "
        "AS DOUBLE)) AS lift FROM (SELECT primary_diagnosis_code, procedure_code, "
        "count(*) AS n FROM g GROUP BY 1, 2)",
    ),
    "gap_duplicates": (
        gap_duplicates,
        _GAPPED_SQL
        + f"SELECT {_KEYS}, provider_id, primary_diagnosis_code, service_date, copies, "
        "row(ok, ln, pk, sk) <> lowest AS is_repeat FROM (SELECT *, count(*) OVER w AS copies, "
        "min(row(ok, ln, pk, sk)) OVER w AS lowest FROM g WINDOW w AS "
        "(PARTITION BY provider_id, primary_diagnosis_code, service_date)) WHERE copies > 1",
    ),
    "gap_provider_history": (
        gap_provider_history,
        t.over("mc", "")
        + f", g AS (SELECT * REPLACE ({_MISSING['provider_id']} AS provider_id) FROM mc) "
        f"SELECT {_KEYS}, CAST(coalesce(n, 0) AS BIGINT) AS earlier_claims, "
        "CAST(r AS DOUBLE) / CAST(n AS DOUBLE) AS earlier_rejection_rate FROM "
        "(SELECT *, nullif(count(*) OVER w, 0) AS n, sum(CAST(is_rejected AS INT)) OVER w AS r "
        f"FROM g WINDOW w AS (PARTITION BY provider_id ORDER BY {_DAY} "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING))",
    ),
    "gap_age_band": (
        gap_age_band,
        _GAPPED_SQL
        + f"SELECT {_KEYS}, age_low, age_high, patient_age < age_low OR patient_age > age_high "
        "AS age_unusual FROM g JOIN (SELECT procedure_code AS pc, "
        "quantile_cont(CAST(patient_age AS DOUBLE), 0.05) AS age_low, "
        "quantile_cont(CAST(patient_age AS DOUBLE), 0.95) AS age_high FROM g GROUP BY 1) "
        "ON procedure_code IS NOT DISTINCT FROM pc",
    ),
    "procedure_gender": (
        procedure_gender,
        _GAPPED_SQL
        + f"SELECT {_KEYS}, share AS gender_share, share < 0.5e0 AS gender_unusual FROM (SELECT *, "
        "CAST(count(*) OVER (PARTITION BY procedure_code, patient_gender) AS DOUBLE) / "
        "CAST(count(*) OVER (PARTITION BY procedure_code) AS DOUBLE) AS share FROM g)",
    ),
}
