"""Stored schemas of the four tables and conforming a frame to them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.functions import half_up

# Column names and stored types of the tables.
TABLES = {
    "raw_applications": """
        customer_id VARCHAR(50), age INT, gender VARCHAR(10), bmi DOUBLE, children INT,
        smoker VARCHAR(10), region VARCHAR(20), charges DOUBLE, medical_history VARCHAR(200),
        employment_status VARCHAR(50), annual_income INT, application_date TIMESTAMP
    """,
    "medical_claims": """
        claim_id VARCHAR(50) NOT NULL, patient_id VARCHAR(50) NOT NULL,
        provider_id VARCHAR(50) NOT NULL, service_date TIMESTAMP NOT NULL,
        submission_date TIMESTAMP NOT NULL, days_to_submission INT, patient_age INT,
        patient_gender VARCHAR(1), patient_state VARCHAR(2), policy_type VARCHAR(10),
        deductible_amount DECIMAL(10,2), copay_amount DECIMAL(10,2),
        provider_specialty VARCHAR(50), provider_network_status VARCHAR(20),
        provider_years_experience INT, provider_monthly_claims INT,
        provider_avg_claim_amount DECIMAL(10,2), primary_diagnosis_code VARCHAR(10),
        procedure_code VARCHAR(10), claim_type VARCHAR(20), billed_amount DECIMAL(10,2),
        amount_per_age DECIMAL(10,2), patient_previous_claims INT,
        patient_previous_rejections INT, patient_rejection_rate DECIMAL(5,3),
        documentation_quality_score DECIMAL(4,3), supporting_documents_count INT,
        is_weekend_submission BOOLEAN, is_after_hours_submission BOOLEAN, submission_hour INT,
        high_fraud_area BOOLEAN, billed_amount_zscore DECIMAL(10,6),
        provider_specialty_risk DECIMAL(5,3), is_rejected BOOLEAN NOT NULL,
        rejection_reason VARCHAR(100), risk_score DECIMAL(4,3)
    """,
    "bpo_claims_processing": """
        claim_id VARCHAR(50) NOT NULL, bpo_internal_ref VARCHAR(50) NOT NULL,
        client_provider_id VARCHAR(50) NOT NULL, provider_specialty VARCHAR(50),
        client_relationship_duration_months INT, provider_data_quality_score DECIMAL(4,3),
        assigned_coder VARCHAR(50), coder_experience_years INT, coder_specialty VARCHAR(20),
        qa_reviewer VARCHAR(50), service_date TIMESTAMP NOT NULL,
        raw_data_received_date TIMESTAMP NOT NULL, claim_prepared_date TIMESTAMP NOT NULL,
        submission_date TIMESTAMP NOT NULL, bpo_processing_hours INT,
        turnaround_sla_met BOOLEAN, raw_data_completeness_score DECIMAL(4,3),
        missing_elements_count INT, required_provider_clarification BOOLEAN,
        documentation_enhancement_score DECIMAL(4,3), prior_authorization_obtained BOOLEAN,
        eligibility_verification_completed BOOLEAN, medical_necessity_enhanced BOOLEAN,
        coding_accuracy_score DECIMAL(4,3), compliance_score DECIMAL(4,3),
        raw_provider_charges DECIMAL(10,2), bpo_coding_adjustments DECIMAL(10,2),
        final_billed_amount DECIMAL(10,2), bpo_fee_percentage DECIMAL(6,4),
        bpo_flat_fee DECIMAL(8,2), primary_payor VARCHAR(50),
        payor_relationship_tier VARCHAR(10), payor_specific_rules_applied BOOLEAN,
        patient_age_group VARCHAR(10), patient_state VARCHAR(2), insurance_type VARCHAR(20),
        primary_diagnosis_code VARCHAR(10), procedure_code VARCHAR(10),
        modifier_codes VARCHAR(20), claim_complexity VARCHAR(20),
        audit_risk_score DECIMAL(4,3), qa_review_required BOOLEAN,
        client_satisfaction_score DECIMAL(3,2), bpo_success_probability DECIMAL(4,3),
        claim_successful BOOLEAN NOT NULL, actual_reimbursement DECIMAL(10,2),
        bpo_fee_earned DECIMAL(10,2), days_to_payment INT, net_collection_rate DECIMAL(4,3),
        requires_appeal BOOLEAN, appeal_success_probability DECIMAL(4,3),
        provider_feedback_required BOOLEAN, bpo_roi DECIMAL(8,2)
    """,
    "bpo_claims_training": """
        claim_id VARCHAR(50) NOT NULL, provider_id VARCHAR(50), bpo_coder VARCHAR(50),
        service_date TIMESTAMP, submission_date TIMESTAMP, days_service_to_submission INT,
        submission_day_of_week INT, submission_hour INT, patient_age INT,
        patient_gender VARCHAR(1), patient_state VARCHAR(2), billed_amount DECIMAL(10,2),
        expected_reimbursement DECIMAL(10,2), amount_per_age DECIMAL(8,2),
        primary_diagnosis_code VARCHAR(10), procedure_code VARCHAR(10), claim_type VARCHAR(20),
        provider_specialty VARCHAR(30), coder_experience_years INT,
        coding_accuracy_score DECIMAL(5,3), documentation_enhancement_score DECIMAL(5,3),
        processing_time_hours INT, prior_authorization_obtained BOOLEAN,
        eligibility_verification_completed BOOLEAN, medical_necessity_documented BOOLEAN,
        qa_review_completed BOOLEAN, provider_data_completeness DECIMAL(5,3),
        missing_documentation_count INT, provider_response_time_hours INT,
        primary_payor VARCHAR(30), network_status VARCHAR(20), payor_tier VARCHAR(10),
        high_dollar_claim BOOLEAN, complex_diagnosis BOOLEAN, weekend_submission BOOLEAN,
        after_hours_submission BOOLEAN, provider_historical_approval_rate DECIMAL(5,3),
        patient_previous_rejections INT, bpo_coder_approval_rate DECIMAL(5,3),
        bpo_quality_score DECIMAL(5,3), provider_risk_score DECIMAL(5,3),
        claim_complexity_score DECIMAL(5,3), is_approved BOOLEAN NOT NULL,
        approval_probability_actual DECIMAL(6,4), rejection_reason VARCHAR(50),
        rejection_category VARCHAR(20), days_to_decision INT, appeal_filed BOOLEAN,
        final_payment_amount DECIMAL(10,2), bpo_prediction_confidence DECIMAL(5,3),
        manual_review_flagged BOOLEAN, qa_override_occurred BOOLEAN
    """,
}
AUDIT_COLUMN = {
    "raw_applications": "created_date",
    "medical_claims": "created_date",
    "bpo_claims_processing": "created_timestamp",
    "bpo_claims_training": "created_timestamp",
}
UNIQUE_KEYS = {
    "raw_applications": [],
    "medical_claims": ["claim_id"],
    "bpo_claims_processing": ["claim_id", "bpo_internal_ref"],
    "bpo_claims_training": ["claim_id"],
}

_FIELD = re.compile(r"(\w+) (\w+)(?:\((\d+)(?:,(\d+))?\))?( NOT NULL)?")


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    size: int | None
    scale: int | None
    required: bool

    def type_text(self) -> str:
        if self.kind == "DECIMAL":
            return f"DECIMAL({self.size},{self.scale})"
        return f"VARCHAR({self.size})" if self.kind == "VARCHAR" else self.kind


def fields(table: str) -> list[Field]:
    return [
        Field(
            m[1], m[2], int(m[3]) if m[3] else None, int(m[4]) if m[4] else None, bool(m[5])
        )
        for m in _FIELD.finditer(TABLES[table])
    ]


def ddl(table: str) -> str:
    """Schema text with the audit column last."""
    columns = [
        f"{f.name} {f.type_text()}{' NOT NULL' if f.required else ''}" for f in fields(table)
    ]
    return ", ".join([*columns, f"{AUDIT_COLUMN[table]} TIMESTAMP"])


def reader_schema(table: str) -> str:
    """Schema for reading text files: numbers as doubles, no audit column."""
    kinds = {"VARCHAR": "STRING", "DECIMAL": "DOUBLE"}
    return ", ".join(f"{f.name} {kinds.get(f.kind, f.kind)}" for f in fields(table))


def _stored(field: Field, column: Column) -> Column:
    if field.kind == "DECIMAL":
        return half_up(column.cast("double"), field.scale).cast(f"decimal({field.size},{field.scale})")
    if field.kind == "VARCHAR":
        text = column.cast("string")
        too_long = F.raise_error(F.concat(F.lit(f"{field.name} is longer than {field.size}: "), text))
        return F.when(F.char_length(text) > field.size, too_long).otherwise(text)
    return column.cast(field.kind.lower())


def conform(frame: DataFrame, table: str, with_audit: bool = True) -> DataFrame:
    """Columns of ``table`` in order, cast to the stored types; absent ones become null.

    A value beyond its decimal range or text length raises, as the store would refuse the row.
    """
    columns = [
        (_stored(f, F.col(f.name)) if f.name in frame.columns else F.lit(None).cast(_sql_type(f)))
        .alias(f.name)
        for f in fields(table)
    ]
    if with_audit:
        columns.append(F.current_timestamp().alias(AUDIT_COLUMN[table]))
    return frame.select(*columns)


def _sql_type(field: Field) -> str:
    return "string" if field.kind == "VARCHAR" else field.type_text().lower()


def create_tables(spark: SparkSession, database: str | None = None, path: str | None = None) -> None:
    """Create the four tables where they do not exist yet."""
    for table in TABLES:
        name = f"{database}.{table}" if database else table
        location = f" LOCATION '{path.rstrip('/')}/{table}'" if path else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(table)}) USING parquet{location}")
