"""Claim and application tables derived from the star-schema test tables.

Each column is one SQL expression over the line base (one row per line item). Integer
division is written ``//`` as in DuckDB; Spark gets ``div``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.session import keep_methods_small, settle

ROW_KEYS = ["ok", "ln", "pk", "sk"]


@dataclass(frozen=True)
class Pick:
    """The value at ``selector`` modulo the number of values."""

    selector: str
    values: tuple[str | None, ...]

    def sql(self) -> str:
        whens = " ".join(
            f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(self.values)
        )
        return f"CASE CAST({self.selector} % {len(self.values)} AS INT) {whens} END"

    def column(self) -> Column:
        # A constant array keeps the generated code small, unlike a long CASE.
        position = F.expr(f"CAST({self.selector} % {len(self.values)} AS INT)")
        return F.get(F.array(*[F.lit(v) for v in self.values]), position)


def _pick(selector: str, values: list[str | None]) -> Pick:
    return Pick(selector, tuple(values))


def _draw(divisor: int, size: int, start: int = 0) -> str:
    return f"CAST({start} + (h // {divisor}) % {size} AS INT)"


def _hundredths(divisor: int, size: int, start: int = 0) -> str:
    return f"CAST({start} + (h // {divisor}) % {size} AS DOUBLE) / 100e0"


def _uniform(divisor: int) -> str:
    return f"CAST(0 + (h // {divisor}) % 1000 AS DOUBLE) / 1000e0"


def _coin(divisor: int) -> str:
    return f"(h // {divisor}) % 2 = 0"


def _padded(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad(CAST({number} AS VARCHAR(20)), {width}, '0'))"


# Value domains of the claim tables.
MEDICAL_SPECIALTIES = [
    "Family Medicine", "Internal Medicine", "Cardiology", "Orthopedics", "Emergency Medicine",
    "Radiology", "Pathology", "Dermatology", "Psychiatry", "Oncology", "Neurology",
    "Gastroenterology",
]
PROCEDURES = ["99213", "99214", "99215", "99203", "99204"]
MEDICAL_REJECTION_REASONS = [
    "Medical necessity not established",
    "Pre-authorization required",
    "Out of network provider",
    "Duplicate claim",
    "Incorrect coding",
    "Missing documentation",
    "Policy exclusion",
    "Benefit exhausted",
    "Experimental treatment",
    "Fraudulent activity suspected",
]

_NETWORK = "CASE WHEN sk % 3 = 0 THEN 'Out-of-Network' ELSE 'In-Network' END"
_STATE = "lpad(CAST(nk AS VARCHAR(2)), 2, '0')"
_GENDER = "CASE WHEN cu % 2 = 0 THEN 'M' ELSE 'F' END"

MEDICAL_CLAIMS = {
    "claim_id": _padded("CLM_", "ok * 10 + ln", 10),
    "patient_id": _padded("PAT_", "cu", 8),
    "provider_id": _padded("PRV_", "sk", 8),
    "service_date": "od",
    "days_to_submission": _draw(3, 91),
    "submission_hour": _draw(5, 24),
    "patient_age": "CAST(18 + cu % 68 AS INT)",
    "patient_gender": _GENDER,
    "patient_state": _STATE,
    "policy_type": _pick("cu", ["HMO", "PPO", "EPO", "POS", "HDHP"]),
    "provider_specialty": _pick("sk", MEDICAL_SPECIALTIES),
    "provider_network_status": _NETWORK,
    "provider_monthly_claims": _draw(7, 200, 1),
    "primary_diagnosis_code": _pick(
        "pk", ["Z00.00", "M79.3", "K21.9", "E11.9", "I10", "J44.1", "I1", "pediatric-J06.9"]
    ),
    "procedure_code": _pick("pk", PROCEDURES),
    "claim_type": _pick("pk", ["Inpatient", "Outpatient", "Emergency", "Pharmacy", "Lab"]),
    "billed_amount": "ep / 4e0",
    "patient_previous_claims": _draw(11, 51),
    "patient_previous_rejections": "CAST(least((h // 13) % 6, (h // 11) % 51) AS INT)",
    "documentation_quality_score": _hundredths(17, 71, 30),
    "supporting_documents_count": _draw(29, 9),
    "high_fraud_area": _coin(23),
    "u_label": _uniform(37),
    "reason_draw": "CAST(h % 10 AS INT)",
}

CLAIMS_TRAINING = {
    "claim_id": _padded("TRN_", "ok * 10 + ln", 10),
    "provider_id": _padded("PROV_", "sk", 8),
    "bpo_coder": _padded("CODER_", "1 + sk % 100", 3),
    "service_date": "od",
    "days_service_to_submission": _draw(3, 90, 1),
    "submission_hour": _draw(5, 24),
    "patient_age": "CAST(18 + cu % 68 AS INT)",
    "patient_gender": _GENDER,
    "patient_state": _STATE,
    "billed_amount": "ep / 8e0",
    "expected_reimbursement": "(ep / 8e0) * (CAST(60 + (h // 41) % 31 AS DOUBLE) / 100e0)",
    "primary_diagnosis_code": _pick("pk", ["Z00.00", "M79.3", "K21.9", "E11.9", "I10", "J44.1"]),
    "procedure_code": _pick("pk", PROCEDURES),
    "claim_type": _pick("pk", ["Inpatient", "Outpatient", "Emergency", "Office_Visit"]),
    "provider_specialty": _pick(
        "sk", ["Family_Medicine", "Internal_Medicine", "Cardiology", "Orthopedics"]
    ),
    "coder_experience_years": _draw(7, 20, 1),
    "coding_accuracy_score": _hundredths(11, 25, 75),
    "documentation_enhancement_score": _hundredths(17, 81),
    "processing_time_hours": _draw(43, 47, 2),
    "prior_authorization_obtained": _coin(47),
    "eligibility_verification_completed": _coin(53),
    "medical_necessity_documented": _coin(59),
    "qa_review_completed": _coin(61),
    "provider_data_completeness": _hundredths(13, 59, 40),
    "missing_documentation_count": _draw(29, 9),
    "provider_response_time_hours": _draw(67, 71, 2),
    "primary_payor": _pick(
        "cu", ["Medicare", "Medicaid", "Anthem", "Aetna", "BCBS", "UnitedHealth"]
    ),
    "network_status": _NETWORK,
    "payor_tier": _pick("cu", ["Tier_1", "Tier_2", "Tier_3"]),
    "provider_historical_approval_rate": _hundredths(71, 36, 60),
    "patient_previous_rejections": _draw(23, 6),
    "bpo_coder_approval_rate": _hundredths(73, 24, 75),
    "u_label": _uniform(37),
    "u_reason": _uniform(79),
    "u_split": "CAST((h // 127) % 1000000 AS INT)",
}

CLAIMS_PROCESSING = {
    "claim_id": _padded("BPO_", "ok * 10 + ln", 10),
    "client_provider_id": _padded("CLIENT_", "1 + sk % 200", 4),
    "assigned_coder": _padded("CODER_", "1 + (pk % 50)", 3),
    "provider_specialty": _pick("sk", MEDICAL_SPECIALTIES[:8]),
    "service_date": "od",
    "coder_experience_years": _draw(7, 15, 1),
    "bpo_processing_hours": _draw(43, 47, 2),
    "raw_data_completeness_score": _hundredths(13, 66, 30),
    "missing_elements_count": _draw(29, 9),
    "required_provider_clarification": _coin(61),
    "documentation_enhancement_score": _hundredths(17, 81),
    "prior_authorization_obtained": "(h // 47) % 4 <> 0",
    "eligibility_verification_completed": "(h // 53) % 10 <> 0",
    "coding_accuracy_score": _hundredths(11, 15, 85),
    "compliance_score": _hundredths(83, 11, 90),
    "raw_provider_charges": "ep / 8e0",
    "bpo_coding_adjustments": "CAST((h // 89) % 1501 AS DOUBLE) - 500e0",
    "bpo_fee_percentage": _hundredths(97, 8, 5),
    "bpo_flat_fee": "CAST(25 * ((h // 101) % 3) AS INT)",
    "qa_flag_draw": _coin(103),
    "primary_payor": _pick(
        "cu", ["Anthem", "Humana", "Aetna", "BCBS", "Medicare", "Medicaid", "UnitedHealth"]
    ),
    "payor_relationship_tier": _pick("cu", ["Tier_1", "Tier_2", "Tier_3"]),
    "client_satisfaction_score": _hundredths(107, 151, 350),
    "modifier_codes": _pick("pk", [None, "25", "59", "GT", "TC"]),
    "payment_rate": _hundredths(109, 26, 70),
    "u_label": _uniform(37),
    "u_appeal": _uniform(113),
}

RAW_APPLICATIONS = {
    "c_custkey": "c_custkey",
    "customer_id": "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE "
    + _padded("CUST_", "c_custkey", 8)
    + " END",
    "age": "CAST(10 + c_custkey % 95 AS INT)",
    "sex": "CASE WHEN c_custkey % 2 = 0 THEN 'MALE' ELSE 'Female' END",
    "bmi": "CASE WHEN c_custkey % 41 = 0 THEN 'n/a' "
    "ELSE CAST(12 + c_custkey % 43 AS VARCHAR(20)) END",
    "children": "CAST(c_custkey % 13 AS INT)",
    "smoker": "CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'NO' END",
    "region": _pick("c_nationkey", ["Northeast", "Northwest", "Southeast", "Southwest"]),
    "charges": "c_acctbal",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    keep_methods_small(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(column: str | Pick) -> str:
    """DuckDB text of a column."""
    return column.sql() if isinstance(column, Pick) else column


def _spark_columns(columns: dict[str, str | Pick]) -> list[Column]:
    found = []
    for name, column in columns.items():
        if isinstance(column, Pick):
            found.append(column.column().alias(name))
        else:
            text = column.replace("//", "div")
            for width in ("VARCHAR(20)", "VARCHAR(2)"):
                text = text.replace(width, "STRING")
            found.append(F.expr(text).alias(name))
    return found


def line_base(
    lines: DataFrame, orders: DataFrame, customers: DataFrame | None, states_first: bool = False
) -> DataFrame:
    """One row per line item with the keys, price, day and hash the claim columns use.

    ``customers`` is needed only for the patient's state; ``states_first`` joins it to the orders, which are
    fewer than the lines. The rows are the same, in another order.
    """
    lines = lines.selectExpr(
        "l_orderkey AS ok",
        "l_partkey AS pk",
        "l_suppkey AS sk",
        "CAST(l_linenumber AS BIGINT) AS ln",
        "l_extendedprice AS ep",
        "l_orderkey*7919 + l_partkey*104729 + l_suppkey*613 + l_linenumber*31 AS h",
    )
    orders = orders.selectExpr(
        "o_orderkey AS ok", "o_custkey AS cu", "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP_NTZ) AS od"
    )
    if customers is None:
        return lines.join(orders, "ok")
    states = customers.selectExpr("c_custkey AS cu", "CAST(c_nationkey AS INT) AS nk")
    if states_first:
        return lines.join(orders.join(states, "cu"), "ok")
    return lines.join(orders, "ok").join(states, "cu")


def _claims(
    spark: SparkSession,
    sf_dir: str,
    columns: dict[str, str | Pick],
    state: bool,
    lines: DataFrame | None,
    stored: bool = False,
) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem") if lines is None else lines
    customers = _table(spark, sf_dir, "customer") if state else None
    base = line_base(lines, _table(spark, sf_dir, "orders"), customers, states_first=stored)
    base = settle(base, "lines") if stored else base
    wanted = {k: v for k, v in columns.items() if state or k != "patient_state"}
    return base.select(*_spark_columns(wanted), *ROW_KEYS)


def medical_claims(spark, sf_dir, state=False, lines=None) -> DataFrame:
    """Medical claims; ``lines`` may be a streaming read of the line items."""
    return _claims(spark, sf_dir, MEDICAL_CLAIMS, state, lines)


def claims_training(spark, sf_dir, state=False, lines=None, stored=False) -> DataFrame:
    """Training claims; ``stored`` ones read their lines, orders and customers once, for several readers."""
    return _claims(spark, sf_dir, CLAIMS_TRAINING, state, lines, stored)


def claims_processing(spark, sf_dir, lines=None) -> DataFrame:
    return _claims(spark, sf_dir, CLAIMS_PROCESSING, False, lines)


def raw_applications(spark, sf_dir, customers=None) -> DataFrame:
    customers = _table(spark, sf_dir, "customer") if customers is None else customers
    return customers.select(*_spark_columns(RAW_APPLICATIONS))


def submission_time(days_column: str) -> Column:
    """Service day plus whole days plus the submission hour."""
    return F.expr(
        f"timestampadd(HOUR, {days_column} * 24 + submission_hour, service_date)"
    )
