"""SQL text of the derived tables, shared by the equivalent-SQL statements."""

from __future__ import annotations

from claimwright.sources import derived
from claimwright.sources.derived import MEDICAL_REJECTION_REASONS

_LINE_BASE = (
    "b AS (SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, "
    "CAST(l.l_linenumber AS BIGINT) AS ln, c.c_custkey AS cu, l.l_extendedprice AS ep, "
    "date_trunc('day', o.o_orderdate) AS od, "
    "l.l_orderkey*7919 + l.l_partkey*104729 + l.l_suppkey*613 + l.l_linenumber*31 AS h, "
    "CAST(n.n_nationkey AS INT) AS nk "
    "FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey "
    "JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey)"
)


def _select(columns: dict, source: str, keys: list[str]) -> str:
    texts = [f"{derived.sql_text(column)} AS {name}" for name, column in columns.items()]
    return f"SELECT {', '.join([*texts, *keys])} FROM {source}"


def half_up(value: str, places: int) -> str:
    scale = f"1e{places}"
    return f"(floor(({value}) * {scale} + 0.5e0) / {scale})"


def exact_sum(value: str, places: int = 4) -> str:
    scale = f"1e{places}"
    return (
        f"(CAST(sum(CAST(floor(({value}) * {scale} + 0.5e0) AS BIGINT)) AS DOUBLE) / {scale})"
    )


def exact_mean(value: str, places: int = 4) -> str:
    return f"({exact_sum(value, places)} / nullif(CAST(count({value}) AS DOUBLE), 0e0))"


def count_if(test: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {test} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def flag_mean(flag: str) -> str:
    return f"avg(CASE WHEN {flag} THEN 1e0 WHEN NOT ({flag}) THEN 0e0 END)"


def fold(base: str, rules: list[tuple[str, str]]) -> str:
    """``base`` with signed deltas added left to right."""
    steps = "".join(f" + CASE WHEN {test} THEN {delta} ELSE 0e0 END" for test, delta in rules)
    return f"({base}{steps})"


_REASONS = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(MEDICAL_REJECTION_REASONS))

_RISK = fold(
    "0e0",
    [
        ("provider_network_status = 'Out-of-Network'", "0.3e0"),
        ("days_to_submission > 30", "0.2e0"),
        ("billed_amount > 10000", "0.2e0"),
        ("patient_previous_rejections > 2", "0.2e0"),
        ("documentation_quality_score < 0.6e0", "0.3e0"),
        ("high_fraud_area", "0.1e0"),
        ("submission_hour < 8 OR submission_hour > 18", "0.1e0"),
        ("provider_monthly_claims > 150", "0.1e0"),
    ],
)

_TRAINING_PROBABILITY = (
    "greatest(0.1e0, least(0.98e0, "
    + fold(
        "0.8e0",
        [
            ("coding_accuracy_score > 0.95e0", "0.1e0"),
            ("coding_accuracy_score < 0.85e0", "(-0.15e0)"),
            ("coder_experience_years > 10", "0.05e0"),
            ("coder_experience_years < 3", "(-0.1e0)"),
            ("prior_authorization_obtained", "0.08e0"),
            ("eligibility_verification_completed", "0.05e0"),
            ("qa_review_completed", "0.03e0"),
            ("documentation_enhancement_score > 0.6e0", "0.05e0"),
            ("network_status = 'Out-of-Network'", "(-0.2e0)"),
            ("provider_data_completeness < 0.7e0", "(-0.15e0)"),
            ("days_service_to_submission > 60", "(-0.1e0)"),
            ("billed_amount > 5000", "(-0.05e0)"),
            ("missing_documentation_count > 3", "(-0.12e0)"),
            ("patient_previous_rejections > 2", "(-0.08e0)"),
            ("primary_payor = 'Medicaid'", "(-0.05e0)"),
            ("primary_payor = 'Medicare'", "(-0.03e0)"),
        ],
    )
    + "))"
)

_REASON_WEIGHTS = [
    ("medical_necessity_not_established", "0.15e0"),
    (
        "insufficient_documentation",
        "0.12e0 * CASE WHEN provider_data_completeness < 0.7e0 THEN 2 ELSE 1 END",
    ),
    ("diagnosis_procedure_mismatch", "0.08e0"),
    ("experimental_investigational", "0.05e0"),
    (
        "missing_prior_authorization",
        "0.10e0 * CASE WHEN NOT prior_authorization_obtained THEN 3 ELSE 1 END",
    ),
    (
        "eligibility_verification_failed",
        "0.08e0 * CASE WHEN NOT eligibility_verification_completed THEN 4 ELSE 1 END",
    ),
    (
        "timely_filing_limit_exceeded",
        "0.06e0 * CASE WHEN days_service_to_submission > 60 THEN 3 ELSE 1 END",
    ),
    ("duplicate_claim_submission", "0.06e0"),
    (
        "incorrect_procedure_code",
        "0.08e0 * CASE WHEN coding_accuracy_score < 0.9e0 THEN 2 ELSE 1 END",
    ),
    (
        "incorrect_diagnosis_code",
        "0.06e0 * CASE WHEN coding_accuracy_score < 0.9e0 THEN 2 ELSE 1 END",
    ),
    ("missing_required_modifiers", "0.04e0"),
    ("bundling_edits_violation", "0.02e0"),
    (
        "out_of_network_provider",
        "0.04e0 * CASE WHEN network_status = 'Out-of-Network' THEN 5 ELSE 1 END",
    ),
    ("provider_not_credentialed", "0.03e0"),
    ("invalid_provider_npi", "0.02e0"),
    ("provider_contract_terminated", "0.01e0"),
]


def reason_weight_rows() -> str:
    """One SELECT per reason, for the long form."""
    return " UNION ALL ".join(
        f"SELECT ok, ln, pk, sk, {i} AS position, '{name}' AS reason, {weight} AS weight FROM ct"
        for i, (name, weight) in enumerate(_REASON_WEIGHTS)
    )


def _reason_pick() -> str:
    running = []
    for i, (_, weight) in enumerate(_REASON_WEIGHTS):
        running.append(f"{weight} AS w{i}")
    weights = ", ".join(running)
    sums = []
    for i in range(len(_REASON_WEIGHTS)):
        sums.append(f"({' + '.join(f'w{j}' for j in range(i + 1))}) AS c{i}")
    last = len(_REASON_WEIGHTS) - 1
    whens = " ".join(
        f"WHEN u_reason * c{last} < c{i} THEN '{name}'" for i, (name, _) in enumerate(_REASON_WEIGHTS)
    )
    return (
        f"ct_w AS (SELECT *, {weights} FROM ct), ct_c AS (SELECT *, {', '.join(sums)} FROM ct_w), "
        f"ct_pick AS (SELECT *, CASE WHEN NOT is_approved THEN CASE {whens} END END "
        "AS rejection_reason FROM ct_c)"
    )


_PROCESSING_PROBABILITY = (
    "greatest(0.1e0, least(0.98e0, "
    + fold(
        "0.7e0",
        [
            ("coding_accuracy_score > 0.95e0", "0.15e0"),
            ("raw_data_completeness_score > 0.9e0", "0.1e0"),
            ("prior_authorization_obtained", "0.1e0"),
            ("eligibility_verification_completed", "0.05e0"),
            ("qa_review_required AND qa_reviewer IS NOT NULL", "0.05e0"),
            ("documentation_enhancement_score > 0.5e0", "0.05e0"),
            ("missing_elements_count > 3", "(-0.2e0)"),
            ("required_provider_clarification", "(-0.15e0)"),
            ("payor_relationship_tier = 'Tier_3'", "(-0.1e0)"),
        ],
    )
    + "))"
)

_DECISION_PROBABILITY = (
    "greatest(0.1e0, least(0.98e0, "
    + fold(
        "0.8e0",
        [
            ("coding_accuracy_score > 0.95e0", "0.1e0"),
            ("coding_accuracy_score < 0.85e0", "(-0.2e0)"),
            ("provider_data_completeness < 0.7e0", "(-0.15e0)"),
            ("prior_authorization_obtained", "0.08e0"),
            ("eligibility_verification_completed", "0.05e0"),
            ("network_status = 'Out-of-Network'", "(-0.25e0)"),
            ("billed_amount > 5000", "(-0.05e0)"),
            ("days_service_to_submission > 60", "(-0.1e0)"),
        ],
    )
    + "))"
)

_CODING = (
    "greatest(0.5e0, "
    + fold(
        "0.95e0",
        [
            ("lower(primary_diagnosis_code) LIKE '%pediatric%' AND patient_age > 18", "(-0.2e0)"),
            (
                "patient_gender = 'M' AND (primary_diagnosis_code LIKE '%pregnancy%' "
                "OR primary_diagnosis_code LIKE '%obstetric%')",
                "(-0.3e0)",
            ),
            ("length(primary_diagnosis_code) < 3 OR length(procedure_code) < 3", "(-0.1e0)"),
        ],
    )
    + ")"
)
_NECESSITY = (
    "((0.9e0 + CASE WHEN billed_amount > 5000 THEN (-0.1e0) ELSE 0e0 END)"
    " * documentation_quality_score)"
)
_SCREENING_TESTS = [
    ("provider_network_status = 'Out-of-Network'", "(-0.3e0)"),
    ("documentation_quality_score < 0.8e0", "(-0.25e0)"),
    ("coding_accuracy < 0.9e0", "(-0.2e0)"),
    ("medical_necessity < 0.8e0", "(-0.25e0)"),
    ("abs(billed_amount_zscore) > 2e0 OR billed_amount > 20000", "(-0.15e0)"),
    ("days_to_submission > 60", "(-0.1e0)"),
    ("patient_rejection_rate > 0.2e0", "(-0.1e0)"),
    ("provider_specialty_risk > 0.25e0", "(-0.1e0)"),
]
SCREENING_LABELS = [
    "'Out-of-network provider'",
    "printf('Poor documentation quality (%.2f)', documentation_quality_score)",
    "'Potential coding errors detected'",
    "'Medical necessity questionable'",
    "'Unusual billing amount detected'",
    "'Delayed submission - may exceed timely filing'",
    "printf('Patient has high rejection history (%.1f%%)', patient_rejection_rate * 100e0)",
    "'Provider specialty has high rejection rate'",
]
SCREENING_ACTIONS = [
    "'Verify patient has out-of-network benefits'",
    "'Request additional documentation from provider'",
    "'Review codes with certified medical coder'",
    "'Obtain supporting clinical documentation'",
    "'Verify charges against fee schedule'",
    "'Submit immediately or check timely filing limits'",
    "'Extra scrutiny - patient has rejection history'",
    "'Follow specialty-specific submission guidelines'",
]


def joined(texts: list[str]) -> str:
    parts = ", ".join(f"CASE WHEN {t} THEN {x} END" for (t, _), x in zip(_SCREENING_TESTS, texts))
    return f"concat_ws('; ', {parts})"


def exploded(texts: list[str]) -> str:
    """One SELECT per rule over the screened rows."""
    return " UNION ALL ".join(
        f"SELECT {x} AS entry FROM mcs WHERE {t}" for (t, _), x in zip(_SCREENING_TESTS, texts)
    )


# Name -> (tables it needs, CTE text). The order is the order of definition.
_TABLES: dict[str, tuple[list[str], str]] = {
    "b": ([], _LINE_BASE),
    "mc0": (["b"], f"mc0 AS ({_select(derived.MEDICAL_CLAIMS, 'b', derived.ROW_KEYS)})"),
    "mc1": (
        ["mc0"],
        "mc1 AS (SELECT *, "
        "service_date + to_hours(days_to_submission*24+submission_hour) AS submission_date, "
        f"{half_up('billed_amount / nullif(CAST(patient_age AS DOUBLE), 0e0)', 2)} AS amount_per_age, "
        + half_up(
            "CAST(patient_previous_rejections AS DOUBLE) / greatest(1, patient_previous_claims)", 3
        )
        + f" AS patient_rejection_rate, {_RISK} AS risk FROM mc0)",
    ),
    # The labelled medical claims.
    "mc": (
        ["mc1"],
        f"mc AS (SELECT *, {half_up('risk', 3)} AS risk_score, "
        "least(risk, 0.9e0) AS rejection_probability, "
        "u_label < least(risk, 0.9e0) AS is_rejected, "
        f"CASE WHEN u_label < least(risk, 0.9e0) THEN CASE reason_draw {_REASONS} END END "
        "AS rejection_reason FROM mc1)",
    ),
    # With the z-score and the specialty risk.
    "mcz": (
        ["mc"],
        "mcz AS (SELECT mc.*, (billed_amount - s.m) / nullif(s.d, 0e0) AS billed_amount_zscore, "
        "r.rate AS provider_specialty_risk FROM mc, "
        "(SELECT avg(billed_amount) AS m, stddev_samp(billed_amount) AS d FROM mc) s "
        "LEFT JOIN (SELECT provider_specialty AS ps, "
        f"{flag_mean('is_rejected')} AS rate FROM mc GROUP BY 1) r "
        "ON mc.provider_specialty = r.ps)",
    ),
    # With the screening results.
    "mcs": (
        ["mcz"],
        f"mcs0 AS (SELECT *, {_CODING} AS coding_accuracy, {_NECESSITY} AS medical_necessity "
        "FROM mcz), "
        f"mcs1 AS (SELECT *, greatest(0e0, {fold('1e0', _SCREENING_TESTS)}) AS score FROM mcs0), "
        "mcs AS (SELECT *, "
        f"{half_up('score', 3)} AS screening_approval_probability, "
        "score >= 0.85e0 AS screening_submit_recommendation, "
        + half_up(
            "billed_amount * (CASE WHEN provider_network_status = 'Out-of-Network' "
            "THEN 0.8e0 * 0.6e0 ELSE 0.8e0 END) * score",
            2,
        )
        + " AS estimated_reimbursement, "
        "CASE WHEN score >= 0.95e0 AND billed_amount > 1000 THEN 'HIGH_PRIORITY_CLEAN' "
        "WHEN score < 0.7e0 THEN 'HOLD_FOR_REVIEW' WHEN billed_amount > 5000 "
        "THEN 'HIGH_VALUE_REVIEW' ELSE 'STANDARD_PROCESSING' END AS processing_priority "
        "FROM mcs1)",
    ),
    "ct0": (["b"], f"ct0 AS ({_select(derived.CLAIMS_TRAINING, 'b', derived.ROW_KEYS)})"),
    # The training claims with base columns, label and probability.
    "ct": (
        ["ct0"],
        "ct1 AS (SELECT *, "
        "service_date + to_hours(days_service_to_submission*24+submission_hour) AS submission_date, "
        f"{half_up('billed_amount / nullif(CAST(patient_age AS DOUBLE), 0e0)', 2)} AS amount_per_age, "
        "billed_amount > 5000 AS high_dollar_claim, "
        "primary_diagnosis_code IN ('E11.9', 'I10', 'J44.1') AS complex_diagnosis, "
        f"{_TRAINING_PROBABILITY} AS probability FROM ct0), "
        "ct AS (SELECT *, CAST(isodow(submission_date) - 1 AS INT) AS submission_day_of_week, "
        "isodow(submission_date) >= 6 AS weekend_submission, "
        "hour(submission_date) < 8 OR hour(submission_date) > 17 AS after_hours_submission, "
        f"{half_up('probability', 4)} AS approval_probability_actual, "
        "u_label < probability AS is_approved FROM ct1)",
    ),
    "ct_pick": (["ct"], _reason_pick()),
    "ct_cat": (
        ["ct_pick"],
        "ct_cat AS (SELECT *, CASE WHEN is_approved THEN 'approved' "
        "WHEN rejection_reason IN ('medical_necessity_not_established', "
        "'insufficient_documentation', 'diagnosis_procedure_mismatch', "
        "'experimental_investigational') THEN 'medical_clinical' "
        "WHEN rejection_reason IN ('missing_prior_authorization', "
        "'eligibility_verification_failed', 'timely_filing_limit_exceeded', "
        "'duplicate_claim_submission') THEN 'administrative' "
        "WHEN rejection_reason IN ('incorrect_procedure_code', 'incorrect_diagnosis_code', "
        "'missing_required_modifiers', 'bundling_edits_violation') THEN 'coding_billing' "
        "WHEN rejection_reason IN ('out_of_network_provider', 'provider_not_credentialed', "
        "'invalid_provider_npi', 'provider_contract_terminated') THEN 'provider_network' "
        "ELSE 'other' END AS rejection_category FROM ct_pick)",
    ),
    # The training claims with production decisions.
    "cd": (
        ["ct"],
        f"cd0 AS (SELECT *, {_DECISION_PROBABILITY} AS p FROM ct), "
        "cd AS (SELECT *, p > 0.5e0 AS predicted_approved, "
        "CASE WHEN p >= 0.75e0 THEN 'SUBMIT' WHEN p >= 0.65e0 THEN 'QA_REVIEW' ELSE 'HOLD' END "
        "AS action, CASE WHEN p >= 0.75e0 THEN CASE WHEN billed_amount > 5000 THEN 'HIGH' "
        "ELSE 'NORMAL' END WHEN p >= 0.65e0 THEN 'MEDIUM' ELSE 'LOW' END AS priority, "
        + half_up(
            "billed_amount * (CASE WHEN network_status = 'In-Network' THEN 0.8e0 ELSE 0.6e0 END) * p",
            2,
        )
        + " AS expected_reimbursement_by_rule FROM cd0)",
    ),
    "cp0": (["b"], f"cp0 AS ({_select(derived.CLAIMS_PROCESSING, 'b', derived.ROW_KEYS)})"),
    # The processing claims with their outcomes.
    "cp": (
        ["cp0"],
        "cp1 AS (SELECT *, greatest(50e0, raw_provider_charges + bpo_coding_adjustments) "
        "AS final_billed_amount, bpo_processing_hours <= 24 AS turnaround_sla_met FROM cp0), "
        "cp2 AS (SELECT *, final_billed_amount > 5000 AND qa_flag_draw AS qa_review_required, "
        "CASE WHEN final_billed_amount > 5000 AND qa_flag_draw THEN assigned_coder END "
        "AS qa_reviewer FROM cp1), "
        f"cp3 AS (SELECT *, {_PROCESSING_PROBABILITY} AS probability FROM cp2), "
        "cp4 AS (SELECT *, u_label < probability AS claim_successful FROM cp3), "
        "cp5 AS (SELECT *, CASE WHEN claim_successful THEN final_billed_amount * payment_rate "
        "ELSE 0e0 END AS reimbursement, NOT claim_successful AND u_appeal < 0.6e0 "
        "AS requires_appeal FROM cp4), "
        "cp6 AS (SELECT *, CASE WHEN claim_successful THEN reimbursement * bpo_fee_percentage "
        "+ bpo_flat_fee ELSE CAST(bpo_flat_fee AS DOUBLE) END AS fee FROM cp5), "
        f"cp AS (SELECT *, {half_up('probability', 3)} AS bpo_success_probability, "
        f"{half_up('reimbursement', 2)} AS actual_reimbursement, "
        f"{half_up('fee', 2)} AS bpo_fee_earned, "
        + half_up(
            "CASE WHEN final_billed_amount > 0 THEN reimbursement / final_billed_amount ELSE 0e0 END",
            3,
        )
        + " AS net_collection_rate, "
        + half_up("CASE WHEN requires_appeal THEN probability * 0.7e0 ELSE 0e0 END", 3)
        + " AS appeal_success_probability, "
        "NOT claim_successful AND raw_data_completeness_score < 0.7e0 "
        "AS provider_feedback_required, "
        + half_up(
            "CASE WHEN bpo_processing_hours > 0 "
            "THEN fee / (bpo_processing_hours * 25) * 100e0 ELSE 0e0 END",
            2,
        )
        + " AS bpo_roi FROM cp6)",
    ),
    "ra": ([], f"ra AS ({_select(derived.RAW_APPLICATIONS, 'customer', [])})"),
    # Applications that pass validation, with categories in lower case.
    "rav": (
        ["ra"],
        "rav AS (SELECT c_custkey, customer_id, CAST(age AS DOUBLE) AS age, "
        "try_cast(bmi AS DOUBLE) AS bmi, children, lower(smoker) AS smoker, "
        "lower(region) AS region, charges, lower(sex) AS gender FROM ra "
        "WHERE customer_id IS NOT NULL AND age IS NOT NULL AND sex IS NOT NULL "
        "AND children IS NOT NULL AND smoker IS NOT NULL AND region IS NOT NULL "
        "AND age BETWEEN 18 AND 100 AND try_cast(bmi AS DOUBLE) BETWEEN 15 AND 50 "
        "AND charges > 0 AND children BETWEEN 0 AND 10)",
    ),
}


def over(table: str, query: str, *more: str) -> str:
    """``query`` with the definitions of ``table`` and ``more`` in front of it."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for parent in _TABLES[name][0]:
            visit(parent)
        if name not in needed:
            needed.append(name)

    for name in (table, *more):
        visit(name)
    return f"WITH {', '.join(_TABLES[n][1] for n in needed)} {query}"
