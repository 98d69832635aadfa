"""Streaming runs over the given tables, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.functions import half_up
from claimwright.operators import decisions as decision_ops
from claimwright.operators import labels, quality, screening
from claimwright.operators import statistics as stats
from claimwright.plans import decisions, quality as quality_plans
from claimwright.plans import screening as screening_plans
from claimwright.session import scratch_path, settle
from claimwright.sources import derived
from claimwright.sources.derived import ROW_KEYS
from claimwright.streaming import ingest


def _stream(spark, sf_dir, table):
    return ingest.table_stream(spark, f"{sf_dir}/{table}.parquet")


def _claims(spark, sf_dir):
    return derived.medical_claims(spark, sf_dir, lines=_stream(spark, sf_dir, "lineitem"))


def _run(spark, name, start):
    """Run a stream to its end in a fresh folder and read the result."""
    folder = scratch_path(spark, name)
    start(f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def stream_claims(spark, sf_dir):
    claims = labels.labelled_claims(labels.with_timing(_claims(spark, sf_dir)))
    dirty = claims.withColumns({n: F.expr(x) for n, x in quality_plans._GAPS.items()})
    out = _run(
        spark, "claims", lambda o, c: ingest.ingest_claims(dirty, o, c, available_now=True)
    )
    return out.select(*ROW_KEYS, "patient_id", "patient_age", "billed_amount", *quality.CLAIM_FLAGS)


def stream_applications(spark, sf_dir):
    raw = derived.raw_applications(spark, sf_dir, _stream(spark, sf_dir, "customer"))
    return _run(
        spark,
        "applications",
        lambda o, c: ingest.ingest_applications(
            raw, o, c, quality_plans.AS_OF, available_now=True
        ),
    )


def stream_batch_statistics(spark, sf_dir):
    """Statistics per micro-batch; all files of the table are one batch."""
    claims = labels.labelled_claims(_claims(spark, sf_dir))
    out = _run(
        spark,
        "statistics",
        lambda o, c: ingest.batch_statistics(claims, o, c, available_now=True),
    )
    return out.select(
        *ROW_KEYS, half_up(F.col("billed_amount_zscore"), 6).alias("billed_amount_zscore")
    )


def stream_screening(spark, sf_dir):
    """Screening of a claim stream against stored statistics."""
    baselines = settle(stats.claim_baselines(screening_plans.labelled(spark, sf_dir)), "baselines")
    claims = stats.with_baselines(labels.labelled_claims(_claims(spark, sf_dir)), baselines)
    screened = screening.screen(claims)
    out = _run(
        spark, "screening", lambda o, c: ingest.append_stream(screened, o, c, available_now=True)
    )
    return out.select(
        *ROW_KEYS,
        "screening_approval_probability",
        "screening_submit_recommendation",
        "estimated_reimbursement",
        "processing_priority",
    )


def stream_decisions(spark, sf_dir):
    claims = derived.claims_training(spark, sf_dir, lines=_stream(spark, sf_dir, "lineitem"))
    decided = decision_ops.decide(claims)
    out = _run(
        spark, "decisions", lambda o, c: ingest.append_stream(decided, o, c, available_now=True)
    )
    return out.select(*decisions._PREDICTION, *decisions._recommendation_columns())


QUERIES = {
    "stream_claims": (stream_claims, quality_plans.QUERIES["validate_claims"][1]),
    "stream_applications": (
        stream_applications,
        quality_plans.QUERIES["backfill_applications"][1],
    ),
    "stream_batch_statistics": (
        stream_batch_statistics,
        screening_plans.QUERIES["billed_zscore"][1],
    ),
    "stream_screening": (stream_screening, screening_plans.QUERIES["screening_scores"][1]),
    "stream_decisions": (stream_decisions, decisions.QUERIES["approval_decisions"][1]),
}
