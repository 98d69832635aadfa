"""Feature matrix, encodings, scaling, splitting and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.operators.applications import dense_ids
from claimwright.session import BROADCAST_ROWS, attach_lookup, settle

# Features by kind, in matrix order.
NUMERIC_FEATURES = [
    "patient_age",
    "days_service_to_submission",
    "submission_day_of_week",
    "submission_hour",
    "billed_amount",
    "expected_reimbursement",
    "amount_per_age",
    "coder_experience_years",
    "coding_accuracy_score",
    "documentation_enhancement_score",
    "processing_time_hours",
    "provider_data_completeness",
    "missing_documentation_count",
    "provider_response_time_hours",
    "provider_historical_approval_rate",
    "patient_previous_rejections",
    "bpo_coder_approval_rate",
]
FLAG_FEATURES = [
    "prior_authorization_obtained",
    "eligibility_verification_completed",
    "medical_necessity_documented",
    "qa_review_completed",
    "high_dollar_claim",
    "complex_diagnosis",
    "weekend_submission",
    "after_hours_submission",
]
CATEGORY_FEATURES = [
    "patient_gender",
    "patient_state",
    "primary_diagnosis_code",
    "procedure_code",
    "claim_type",
    "provider_specialty",
    "primary_payor",
    "network_status",
    "payor_tier",
]
DERIVED_FEATURES = ["bpo_quality_score", "provider_risk_score", "claim_complexity_score"]
ONE_HOT_LIMIT = 10


def present(frame: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in frame.columns]


def category_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` of all category columns, from one pass over the table."""
    return (
        frame.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequency_encode(frame: DataFrame, column: str, counts: DataFrame) -> DataFrame:
    """``<column>_frequency``: how often the row's value occurs in the whole table."""
    frequency = counts.filter(F.col("feature") == column).select(
        F.col("value").alias(column), F.col("n").alias(f"{column}_frequency")
    )
    return attach_lookup(frame, frequency, [column], settled=True)


def one_hot_columns(column: str, values: Sequence[str]) -> list[Column]:
    """0/1 columns ``<column>_<value>`` in sorted order; all 0 for a null."""
    return [
        F.coalesce(F.col(column) == value, F.lit(False)).cast("int").alias(f"{column}_{value}")
        for value in sorted(values)
    ]


def prepare_features(
    frame: DataFrame, carry: Sequence[str] = (), limit: int = ONE_HOT_LIMIT
) -> tuple[DataFrame, list[str]]:
    """Feature columns in matrix order after the ``carry`` columns, and their names.

    Absent columns are skipped. A category with more than ``limit`` values is encoded by
    frequency over all rows, others as one 0/1 column per value.
    """
    categories = present(frame, CATEGORY_FEATURES)
    counts = settle(category_counts(frame, categories), "categories") if categories else None
    few: dict[str, list[str]] = {}
    if counts is not None:
        sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("values"))
        small = counts.join(F.broadcast(sizes.filter(F.col("values") <= limit)), "feature", "left_semi")
        # At most ``limit`` values for each of the listed features reach the driver.
        for row in small.select("feature", "value").collect():
            few.setdefault(row["feature"], []).append(row["value"])
    columns: list[Column] = [F.col(n).cast("double").alias(n) for n in present(frame, NUMERIC_FEATURES)]
    columns += [F.col(n).cast("int").alias(n) for n in present(frame, FLAG_FEATURES)]
    for name in categories:
        if name in few:
            columns += one_hot_columns(name, few[name])
        else:
            frame = frequency_encode(frame, name, counts)
            columns.append(F.col(f"{name}_frequency"))
    columns += [F.col(n) for n in present(frame, DERIVED_FEATURES)]
    matrix = frame.select(*carry, *columns)
    return matrix, matrix.columns[len(carry) :]


def scale(frame: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, with statistics from ``fit_on``.

    A column without spread is only centred.
    """
    source = frame if fit_on is None else fit_on
    stats = source.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        ).alias("stats")
    ).scalar()
    return frame.withColumns(
        {
            c: (F.col(c) - stats.getField(f"{c}_mean"))
            / F.coalesce(F.nullif(stats.getField(f"{c}_std"), F.lit(0.0)), F.lit(1.0))
            for c in columns
        }
    )


SPLIT_BUCKETS = 1000
# The last buckets of this many labels are looked up in a map.
_FEW_LABELS = 100


def hash_bucket(*keys: str, seed: int = 42) -> Column:
    """Bucket in [0, 1000) that depends only on the row's keys and the seed."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(SPLIT_BUCKETS)).cast("int")


def split_cutoffs(
    frame: DataFrame, bucket: Column, label: str | None = None, fraction: float = 0.8
) -> DataFrame:
    """Per label, the last bucket of its training part and how many rows that has; stored.

    Rows are counted per label and hash bucket; a label's training part is its lowest
    buckets that together reach the fraction. The window sees one row per bucket.
    """
    by = [label] if label else []
    counts = frame.withColumn("_bucket", bucket).groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    reached = F.sum("n").over(upto) >= F.ceil(F.sum("n").over(whole) * F.lit(fraction))
    # Rows without a bucket count for the fraction but are in neither part.
    known = F.sum(F.when(F.col("_bucket").isNotNull(), F.col("n"))).over(upto)
    last = F.col("_reached") & F.col("_bucket").isNotNull()
    cutoffs = (
        counts.withColumns({"_reached": reached, "_known": known})
        .groupBy(*by)
        .agg(F.min(F.when(last, F.col("_bucket"))).alias("_cutoff"), F.min(F.when(last, F.col("_known"))).alias("_train"))
    )
    return settle(cutoffs, "cutoffs")


def split_flag(
    frame: DataFrame,
    bucket: Column,
    label: str | None = None,
    fraction: float = 0.8,
    cutoffs: DataFrame | None = None,
) -> DataFrame:
    """Add ``is_train``, true for about ``fraction`` of the rows of each label, see ``split_cutoffs``."""
    by = [label] if label else []
    cutoffs = split_cutoffs(frame, bucket, label, fraction) if cutoffs is None else cutoffs
    staged = frame.withColumn("_bucket", bucket)
    if label and cutoffs.limit(_FEW_LABELS + 1).count() <= _FEW_LABELS:
        # No join, so that a filter on the flag comes before the frame's other columns are computed.
        pairs = F.collect_list(F.struct(F.col(label), "_cutoff"))
        known = cutoffs.filter(F.col(label).isNotNull()).agg(F.map_from_entries(pairs)).scalar()
        cutoff = F.try_element_at(known, F.col(label))
    elif label:
        staged = attach_lookup(staged, cutoffs.select(*by, "_cutoff"), by, settled=True)
        cutoff = F.col("_cutoff")
    else:
        cutoff = cutoffs.select("_cutoff").scalar()
    return staged.withColumn("is_train", F.col("_bucket") <= cutoff).drop("_bucket", "_cutoff")


def exact_split(
    frame: DataFrame,
    keys: Sequence[str],
    label: str | None = None,
    test: float = 0.2,
    order: Column | None = None,
    bins: int = 4096,
    most: int = 10_000,
) -> DataFrame:
    """Add ``is_train``: of the n rows of each label exactly n - ceil(``test`` n), the first by ``order``.

    ``order`` is a whole number per row, by default a hash of the keys; ties are broken by the keys. The
    label's last training row is found by counts per bin of ``order``: the bin that holds it is cut into
    bins again until it has at most ``most`` rows or one value. Only the rows of these bins are numbered,
    over sorted ranges. Labels, null being one, may be as uneven as they are; no label is sorted as a whole.
    """
    value = F.shiftrightunsigned(F.xxhash64(F.lit("split"), *keys), 1) if order is None else order.cast("long")
    name = F.lit(None).cast("string") if label is None else F.col(label)
    rows = settle(frame.withColumns({"_label": name, "_value": value}), "split")
    n = F.count(F.lit(1))
    cuts = rows.groupBy("_label").agg(
        (n - F.ceil(n * F.lit(test))).cast("long").alias("_train"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
        F.lit(0).cast("long").alias("_before"),
        n.alias("_inside"),
    )
    cuts = settle(cuts.withColumnRenamed("_label", "_of"), "cuts")

    def cut_rows(cuts: DataFrame) -> DataFrame:
        """Rows beside their label's cut."""
        lookup = F.broadcast(cuts) if cuts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else cuts
        return rows.join(lookup, F.col("_label").eqNullSafe(F.col("_of")))

    wide = (F.col("_inside") > most) & (F.col("_low") < F.col("_high"))
    while not cuts.filter(wide).isEmpty():
        span = F.expr(f"(CAST(_high AS DECIMAL(20,0)) - _low) div {bins} + 1")
        at = F.expr("CAST((CAST(_value AS DECIMAL(20,0)) - _low) div _span AS INT)")
        inside = cut_rows(cuts.withColumn("_span", span)).filter("_value BETWEEN _low AND _high")
        cells = inside.groupBy("_of", "_train", "_before", at.alias("_bin")).agg(
            n.alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
        )
        upto = Window.partitionBy("_of").orderBy("_bin")  # at most ``bins`` rows
        summed = cells.withColumns(
            {
                "_until": F.col("_before") + F.sum("_n").over(upto) - F.col("_n"),
                "_final": F.col("_bin") == F.max("_bin").over(Window.partitionBy("_of")),
            }
        )
        holds = (F.col("_until") <= F.col("_train")) & (F.col("_train") < F.col("_until") + F.col("_n"))
        none_left = F.col("_until") + F.col("_n") == F.col("_train")
        chosen = summed.filter(holds | (none_left & F.col("_final")))
        cuts = settle(
            chosen.select("_of", "_train", "_low", "_high", F.col("_until").alias("_before"), F.col("_n").alias("_inside")),
            "cuts",
        )
    placed = cut_rows(cuts)
    last = "_value BETWEEN _low AND _high"
    numbered = dense_ids(placed.filter(last), ["_label", "_value", *keys], "_place")
    firsts = numbered.groupBy(F.col("_label").alias("_of")).agg(F.min("_place").alias("_first"))
    lookup = F.broadcast(firsts) if cuts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else firsts
    own = numbered.drop("_of").join(lookup, F.col("_label").eqNullSafe(F.col("_of")))
    inner = own.withColumn("is_train", F.col("_before") + F.col("_place") - F.col("_first") < F.col("_train"))
    outer = placed.filter(f"NOT ({last})").withColumn("is_train", F.col("_value") < F.col("_low"))
    columns = [*[F.col(f"`{c}`") for c in frame.columns], "is_train"]
    return inner.select(*columns).unionByName(outer.select(*columns))


def class_weights(frame: DataFrame, label: str) -> DataFrame:
    """Weight rows / (classes x rows of the class) per class."""
    counts = settle(
        frame.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")),
        "classes",
    )
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.select(
        label,
        "n",
        (totals.getField("rows").cast("double") / (totals.getField("classes") * F.col("n"))).alias(
            "weight"
        ),
    )


def with_class_weights(frame: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(frame, label).select(label, F.col("weight").alias(name))
    return attach_lookup(frame, weights, [label])


def interaction(*columns: str) -> Column:
    """Crossed category value."""
    return F.concat_ws(" x ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


# Feature categories with descriptions.
FEATURE_CATALOGUE = {
    "High Impact Features (Most Predictive)": {
        "provider_network_status": "In-network vs out-of-network providers have different rejection rates",
        "documentation_quality_score": "Poor documentation is a major cause of rejections",
        "billed_amount_zscore": "Claims with unusual amounts (too high/low) are often rejected",
        "provider_specialty_risk": "Some specialties have higher rejection rates",
        "patient_rejection_rate": "Patients with history of rejections are higher risk",
        "days_to_submission": "Late submissions often get rejected",
        "risk_score": "Composite risk score based on multiple factors",
    },
    "Clinical Features": {
        "primary_diagnosis_code": "Certain diagnoses are more commonly rejected",
        "procedure_code": "Some procedures have higher rejection rates",
        "claim_type": "Emergency, inpatient, outpatient have different patterns",
        "supporting_documents_count": "Insufficient documentation leads to rejections",
    },
    "Financial Features": {
        "billed_amount": "Very high or very low amounts are suspicious",
        "amount_per_age": "Unusual cost relative to patient age",
        "deductible_amount": "Policy terms affect approval likelihood",
        "copay_amount": "Patient financial responsibility",
    },
    "Provider Behavior Features": {
        "provider_monthly_claims": "Unusually high claim volume is suspicious",
        "provider_avg_claim_amount": "Provider billing patterns",
        "provider_years_experience": "Experience affects coding accuracy",
        "provider_specialty": "Different specialties have different risk profiles",
    },
    "Temporal Features": {
        "is_weekend_submission": "Weekend submissions may indicate urgency or fraud",
        "is_after_hours_submission": "After-hours patterns",
        "submission_hour": "Time of submission patterns",
        "service_date": "Seasonality and timing effects",
    },
    "Patient Demographics": {
        "patient_age": "Age affects treatment appropriateness",
        "patient_gender": "Gender-specific medical patterns",
        "patient_state": "Geographic risk factors",
        "policy_type": "HMO vs PPO vs others have different rules",
    },
    "Fraud Indicators": {
        "high_fraud_area": "Geographic fraud hotspots",
        "patient_previous_rejections": "History of problematic claims",
        "provider_monthly_claims": "Billing mill indicators",
    },
}


def feature_catalogue(spark) -> DataFrame:
    rows = [
        (category, feature, text)
        for category, features in FEATURE_CATALOGUE.items()
        for feature, text in features.items()
    ]
    return spark.createDataFrame(rows, "category string, feature string, description string")


def catalogue_coverage(frame: DataFrame) -> DataFrame:
    """The catalogue with each feature's non-null rows in ``frame``; 0 where absent."""
    names = sorted({f for features in FEATURE_CATALOGUE.values() for f in features})
    have = [n for n in names if n in frame.columns]
    filled = frame.agg(*[F.count(n).alias(n) for n in have]).unpivot([], have, "feature", "non_null")
    # Both sides are at most as long as the catalogue.
    return (
        feature_catalogue(frame.sparkSession)
        .join(F.broadcast(filled), "feature", "left")
        .withColumn("non_null", F.coalesce("non_null", F.lit(0)))
    )


