"""Validation, constraint reports and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.session import attach_lookup
from claimwright.sources import schemas


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


# ---- medical claims --------------------------------------------------------------------

CLAIM_FLAGS = [
    "is_rejected",
    "is_weekend_submission",
    "is_after_hours_submission",
    "high_fraud_area",
]


def claim_rules() -> dict[str, Column]:
    """Rule name to predicate; a null value fails its rule."""
    return {
        "claim_id": F.col("claim_id").isNotNull(),
        "patient_id": F.col("patient_id").isNotNull(),
        "provider_id": F.col("provider_id").isNotNull(),
        "patient_age": F.col("patient_age").between(0, 120),
        "billed_amount": (F.col("billed_amount") > 0) & ~F.isnan(F.col("billed_amount").cast("double")),
        "documentation_quality_score": F.col("documentation_quality_score").between(0, 1),
    }


def validate_claims(claims: DataFrame) -> DataFrame:
    """Rows that pass every rule, with the flag columns as booleans."""
    valid = claims.filter(_all(list(claim_rules().values())))
    return valid.withColumns(
        {c: F.col(c).cast("boolean") for c in CLAIM_FLAGS if c in claims.columns}
    )


def passes(rules: dict[str, Column]) -> Column:
    """Whether a row passes every rule; an unknown test is a failure."""
    return _all([F.coalesce(test, F.lit(False)) for test in rules.values()])


def removal_measures(rules: dict[str, Column]) -> list[Column]:
    """Initial and kept rows and the failures of each rule, as aggregates."""
    failed = {name: ~F.coalesce(test, F.lit(False)) for name, test in rules.items()}
    return [
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(passes(rules)).alias("kept_rows"),
        *[F.count_if(test).alias(f"failed_{name}") for name, test in failed.items()],
    ]


def removal_counts(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Initial, kept and removed rows and the failures of each rule, in one pass."""
    totals = frame.agg(*removal_measures(rules))
    return totals.withColumn("removed_rows", F.col("initial_rows") - F.col("kept_rows"))


# ---- constraints -----------------------------------------------------------------------


def constraint_tests(frame: DataFrame, table: str) -> dict[tuple[str, str], Column]:
    """(column, rule) to a predicate that is true for a violating value."""
    found: dict[tuple[str, str], Column] = {}
    for field in schemas.fields(table):
        if field.name not in frame.columns:
            continue
        column = F.col(field.name)
        if field.required:
            found[field.name, "not_null"] = column.isNull()
        if field.kind == "VARCHAR":
            found[field.name, "max_length"] = F.length(column) > field.size
        if field.kind == "DECIMAL":
            limit = float(10 ** (field.size - field.scale))
            rounded = F.abs(schemas.half_up(column.cast("double"), field.scale))
            found[field.name, "range"] = rounded >= limit
    return found


def quality_report(frame: DataFrame, table: str) -> DataFrame:
    """Violations of every constraint of ``table``, counted in one pass."""
    tests = constraint_tests(frame, table)
    names = {f"{column}:{rule}": test for (column, rule), test in tests.items()}
    row = frame.agg(*[F.count_if(test).alias(name) for name, test in names.items()])
    parts = F.split(F.col("constraint"), ":")
    return row.unpivot([], [F.col(f"`{n}`") for n in names], "constraint", "violations").select(
        F.lit(table).alias("table_name"),
        parts[0].alias("column_name"),
        parts[1].alias("rule"),
        "violations",
    )


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def keep_first(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    A minimum over structs is combined on the map side, so a key with very many copies
    sends one row per task and never fills one.
    """
    rest = [c for c in frame.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return frame.groupBy(*keys).agg(first).select(
        *[c if c in keys else F.col("_first").getField(c).alias(c) for c in frame.columns]
    )


DUPLICATE_KEY = ["patient_id", "provider_id", "service_date", "procedure_code"]


def duplicate_claims(
    claims: DataFrame, keys: Sequence[str] = tuple(DUPLICATE_KEY), order: Sequence[str] = ("claim_id",)
) -> DataFrame:
    """Claims in a group of same patient, provider, service date and procedure.

    Each comes with the group size and whether it follows the group's first claim in
    ``order``. Claims that tie for first are all first; ``keep_first`` drops such copies. Null
    keys are equal to each other.
    """
    groups = (
        claims.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*order)).alias("_first"))
        .filter(F.col("copies") > 1)
    )
    marked = attach_lookup(claims, groups, list(keys), null_safe=True).filter(
        F.col("copies").isNotNull()
    )
    return marked.withColumn("is_repeat", F.struct(*order) != F.col("_first")).drop("_first")


# ---- denial rules ----------------------------------------------------------------------

# Denial issue, the check that finds it, the action that prevents it.
DENIAL_RULES = [
    ("missing_authorization", "pre_auth_required", "Obtain pre-authorization before submission"),
    ("incorrect_coding", "coding_accuracy_score", "Review coding with certified coder"),
    (
        "missing_documentation",
        "documentation_completeness",
        "Request missing documents from provider",
    ),
    (
        "medical_necessity",
        "medical_necessity_score",
        "Obtain physician notes supporting necessity",
    ),
    ("duplicate_claim", "duplicate_detection", "Check for previous submissions"),
    ("eligibility_issue", "patient_eligibility", "Verify patient insurance eligibility"),
]
# Denial issue of each reason that production decisions give.
ISSUE_OF_REASON = {
    "missing_prior_authorization": "missing_authorization",
    "eligibility_verification_failed": "eligibility_issue",
    "insufficient_documentation": "missing_documentation",
    "incorrect_coding": "incorrect_coding",
    "medical_necessity_not_established": "medical_necessity",
    "duplicate_claim_submission": "duplicate_claim",
}


def with_denial_action(frame: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """Issue, check and preventive action for each row's rejection reason."""
    spark = frame.sparkSession
    rules = spark.createDataFrame(
        DENIAL_RULES, "issue string, denial_check string, denial_action string"
    )
    issues = F.create_map(*[F.lit(x) for pair in ISSUE_OF_REASON.items() for x in pair])
    # The rule table has six rows, so broadcasting it is safe.
    return frame.withColumn("issue", F.try_element_at(issues, F.col(reason))).join(
        F.broadcast(rules), "issue", "left"
    )
