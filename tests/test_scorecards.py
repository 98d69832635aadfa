import random

import pytest
from pyspark.sql import functions as F

from claimwright.functions import Inputs, Rule
from claimwright.operators import decisions, reports, screening
from tests import rows

SCREENING = (
    "claim_id string, provider_network_status string, documentation_quality_score double, "
    "billed_amount double, billed_amount_zscore double, primary_diagnosis_code string, "
    "procedure_code string, patient_age int, patient_gender string, days_to_submission int, "
    "patient_rejection_rate double, provider_specialty_risk double"
)
DECISION = (
    "claim_id string, patient_age int, billed_amount double, coding_accuracy_score double, "
    "provider_data_completeness double, coder_experience_years int, "
    "days_service_to_submission int, prior_authorization_obtained boolean, "
    "eligibility_verification_completed boolean, network_status string, "
    "documentation_enhancement_score double"
)
DEMO = ("CLM_DEMO001", "In-Network", 0.85, 2500.0, 0.5, "M79.3", "99214", 45, "F", 5, 0.1, 0.15)
DEMO_1 = ("DEMO_001", 45, 2500.0, 0.95, 0.9, 8, 10, True, True, "In-Network", 0.7)
DEMO_2 = ("DEMO_002", 65, 8500.0, 0.82, 0.6, 3, 45, False, False, "Out-of-Network", 0.3)


def test_screening_demo_claim(spark):
    claims = spark.createDataFrame([DEMO], SCREENING)
    row = screening.screen(claims, keep_arrays=True).first()
    assert row.screening_approval_probability == 0.75
    assert row.screening_risk_factors == ["Medical necessity questionable"]
    assert row.screening_recommendations == ["Obtain supporting clinical documentation"]
    assert row.screening_submit_recommendation is False
    assert row.estimated_reimbursement == 1500.0
    assert row.processing_priority == "STANDARD_PROCESSING"
    text = screening.screen(claims).first()
    assert text.screening_risk_factors == "Medical necessity questionable"


def test_decision_demo_claims(spark):
    claims = spark.createDataFrame([DEMO_1, DEMO_2], DECISION)
    first, second = decisions.decide(claims).orderBy("claim_id").collect()
    assert (first.approval_probability, first.confidence_score) == (0.93, 0.57)
    assert first.predicted_approved and first.rejection_reason is None
    assert first.recommendation.asDict() == {
        "action": "SUBMIT",
        "priority": "NORMAL",
        "recommendations": [],
        "expected_reimbursement": 1860.0,
    }
    assert (second.approval_probability, second.confidence_score) == (0.15, 0.65)
    assert second.rejection_reason == "missing_prior_authorization"
    assert second.recommendation.action == "HOLD" and second.recommendation.priority == "LOW"
    assert second.recommendation.recommendations == [
        "Review coding with senior coder",
        "Request additional documentation from provider",
        "Obtain prior authorization before submission",
        "Verify out-of-network benefits",
    ]
    assert second.recommendation.expected_reimbursement == 765.0


def test_batch_summary_of_demo_claims(spark):
    claims = spark.createDataFrame([DEMO_1, DEMO_2] * 50, DECISION)
    facts = decisions.decision_facts(claims)
    row = reports.batch_summary(facts).first()
    assert (row.total_claims, row.submit_count, row.qa_review_count, row.hold_count) == (100, 50, 0, 50)
    assert (row.total_billed, row.expected_reimbursement) == (550000.0, 131250.0)
    assert (row.submission_rate, row.expected_pay_rate) == (0.5, 0.239)
    metrics = {r.metric: r.value for r in reports.dashboard_metrics(facts).collect()}
    assert metrics["quality_gate"] == 0.5 and metrics["claims_per_hour"] == 12.5


def test_empty_batch_keeps_columns(spark):
    empty = spark.createDataFrame([], DECISION)
    row = reports.batch_summary(decisions.decision_facts(empty)).first()
    assert row.total_claims == 0 and row.submission_rate == 0.0 and row.total_billed == 0.0
    screened = screening.screen(spark.createDataFrame([], SCREENING))
    assert "processing_priority" in screened.columns and screened.count() == 0


@pytest.mark.parametrize(
    "column, at, fires_at",
    [
        ("documentation_quality_score", 0.8, (True, False, False)),
        ("days_to_submission", 60, (False, False, True)),
        ("patient_rejection_rate", 0.2, (False, False, True)),
        ("provider_specialty_risk", 0.25, (False, False, True)),
    ],
)
def test_screening_thresholds(spark, column, at, fires_at):
    step = 1 if isinstance(at, int) else 0.01
    names = [c.split()[0] for c in SCREENING.split(", ")]
    label = {
        "documentation_quality_score": "Poor documentation",
        "days_to_submission": "Delayed submission",
        "patient_rejection_rate": "Patient has high",
        "provider_specialty_risk": "Provider specialty",
    }[column]
    data = []
    for i, value in enumerate((at - step, at, at + step)):
        row = dict(zip(names, DEMO), claim_id=str(i))
        row[column] = value
        data.append(tuple(row[n] for n in names))
    found = screening.screen(spark.createDataFrame(data, SCREENING)).orderBy("claim_id").collect()
    assert tuple(label in r.screening_risk_factors for r in found) == fires_at


def test_action_thresholds(spark):
    values = [0.649, 0.65, 0.749, 0.75]
    frame = spark.createDataFrame([(v,) for v in values], "p double")
    actions = [r[0] for r in frame.select(decisions.decision_action(F.col("p"))).collect()]
    assert actions == ["HOLD", "QA_REVIEW", "QA_REVIEW", "SUBMIT"]


def test_nan_and_null_do_not_fire(spark):
    nan = float("nan")
    gaps = [
        ("a", None, nan, nan, nan, None, None, None, None, None, nan, nan),
        ("b", None, None, None, None, None, None, None, None, None, None, None),
    ]
    found = screening.screen(spark.createDataFrame(gaps, SCREENING)).collect()
    for row in found:
        # Only the coding rule fires, for the missing codes.
        assert row.screening_approval_probability == 0.8
        assert row.screening_risk_factors == "Potential coding errors detected"
        assert row.estimated_reimbursement is None


def test_absent_columns_use_defaults(spark):
    row = decisions.decide(spark.createDataFrame([("x",)], "other string")).first()
    assert row.claim_id == "UNKNOWN"
    assert row.approval_probability == 0.85
    assert row.recommendation.expected_reimbursement == 680.0
    screened = screening.screen(spark.createDataFrame([("x",)], "claim_id string")).first()
    assert "Poor documentation quality (0.00)" in screened.screening_risk_factors


def test_fallback_rows(spark):
    gap = (*DEMO_1[:7], None, *DEMO_1[8:])
    row = decisions.decide(spark.createDataFrame([gap], DECISION)).first()
    assert (row.approval_probability, row.confidence_score) == (0.75, 0.6)
    assert row.recommendation.action == "QA_REVIEW"
    assert row.recommendation.expected_reimbursement == 1875.0
    text = DECISION.replace("coding_accuracy_score double", "coding_accuracy_score string")
    bad = (*DEMO_1[:3], "n/a", *DEMO_1[4:])
    assert decisions.decide(spark.createDataFrame([bad], text)).first().approval_probability == 0.75
    whole = decisions.decide(spark.createDataFrame([DEMO_2], DECISION), use_fallback=True).first()
    assert whole.recommendation.priority == "MEDIUM"


def test_own_rules_extend_the_card(spark):
    claims = spark.createDataFrame([DEMO], SCREENING)
    own = Rule("payor", F.col("billed_amount") > 2000, -0.05, "Missing payor form", action="Add form")
    card = screening.screening_card(Inputs(claims)).extended(own)
    row = screening.screen(claims, card, keep_arrays=True).first()
    assert row.screening_approval_probability == 0.7
    assert row.screening_risk_factors[-1] == "Missing payor form"
    clean = (*DEMO[:2], 1.0, *DEMO[3:])
    rows_ = spark.createDataFrame([clean], SCREENING)
    assert screening.screen(rows_).first().screening_submit_recommendation is True
    blocked = screening.screen(rows_, card).first()
    assert blocked.screening_submit_recommendation is False


def _random_claims(count):
    rng = random.Random(7)

    def maybe(value):
        return None if rng.random() < 0.08 else value

    def number(choices, low, high):
        return maybe(rng.choice(choices) if rng.random() < 0.4 else rng.uniform(low, high))

    screening_rows, decision_rows = [], []
    for i in range(count):
        screening_rows.append(
            (
                str(i),
                maybe(rng.choice(["In-Network", "Out-of-Network"])),
                number([0.8, 0.79, 0.81, float("nan")], 0.3, 1.0),
                number([5000.0, 20000.0, 1000.0, float("nan")], 50, 25000),
                number([2.0, -2.0, -2.5, 2.5], -3, 3),
                maybe(rng.choice(["M79.3", "I1", "Pediatric-J06", "pregnancy-O80", "obstetric"])),
                maybe(rng.choice(["99213", "99"])),
                maybe(rng.choice([10, 18, 19, 60])),
                maybe(rng.choice(["M", "F"])),
                maybe(rng.choice([30, 60, 61, 90])),
                number([0.2, 0.21], 0, 1),
                number([0.25, 0.26], 0, 1),
            )
        )
        decision_rows.append(
            (
                str(i),
                40,
                number([5000.0, 5001.0], 100, 15000),
                number([0.95, 0.85, 0.96, 0.84], 0.75, 1.0),
                number([0.7, 0.69, 0.8], 0.4, 1.0),
                5,
                maybe(rng.choice([60, 61, 90, 91])),
                rng.random() < 0.5,
                rng.random() < 0.5,
                maybe(rng.choice(["In-Network", "Out-of-Network", "Other"])),
                0.5,
            )
        )
    return screening_rows, decision_rows


def test_columns_equal_row_rules(spark):
    screening_rows, decision_rows = _random_claims(1500)
    claims = spark.createDataFrame(screening_rows, SCREENING)
    card = screening.screening_card(Inputs(claims))
    for row in claims.withColumn("score", card.score()).collect():
        assert row.score == rows.screening_score(row.asDict()), row
        assert 0.0 <= row.score <= 1.0
    claims = spark.createDataFrame(decision_rows, DECISION)
    card = decisions.approval_card(Inputs(claims))
    for row in claims.withColumn("p", card.score()).collect():
        assert row.p == rows.decision_probability(row.asDict()), row
        assert 0.1 <= row.p <= 0.98


def test_lists_match_and_partitions_do_not_matter(spark):
    screening_rows, _ = _random_claims(400)
    claims = spark.createDataFrame(screening_rows, SCREENING)
    one = screening.screen(claims.coalesce(1), keep_arrays=True)
    many = screening.screen(claims.repartition(8), keep_arrays=True)
    first = sorted(map(repr, one.collect()))
    assert first == sorted(map(repr, many.collect()))
    sizes = one.filter(F.size("screening_risk_factors") != F.size("screening_recommendations"))
    assert sizes.count() == 0
    assert (
        reports.pay_rate_summary(one).collect() == reports.pay_rate_summary(many).collect()
    )


def test_top_slots_share_and_ties(spark):
    slots = spark.createDataFrame(
        [(["b", None],), (["a", "b"],), (["a", None],), ([None, None],)], "slots array<string>"
    )
    found = reports.top_slots(slots, "factor", k=2, with_share=True).orderBy("factor").collect()
    assert [(r.factor, r.claims, r.percentage) for r in found] == [("a", 2, 50.0), ("b", 2, 50.0)]
