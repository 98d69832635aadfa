"""Insurance applications: validation, backfill and expected charges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.functions import items_where
from claimwright.session import shared_dir

# Columns every stored application has.
REQUIRED = ["customer_id", "age", "gender", "bmi", "children", "smoker", "region", "charges"]
NUMERIC = ["age", "bmi", "charges"]
CATEGORIES = ["gender", "smoker", "region"]


def to_numbers(applications: DataFrame) -> DataFrame:
    """Numeric columns as doubles; unreadable text and NaN become null."""

    def number(name: str) -> Column:
        value = F.col(name).try_cast("double")
        return F.when(~F.isnan(value), value)

    return applications.withColumns({c: number(c) for c in NUMERIC if c in applications.columns})


def normalize_categories(applications: DataFrame) -> DataFrame:
    """Lower-case categories; ``sex`` becomes ``gender`` where there is no gender."""
    if "gender" not in applications.columns and "sex" in applications.columns:
        applications = applications.withColumnRenamed("sex", "gender")
    return applications.withColumns(
        {c: F.lower(c) for c in CATEGORIES if c in applications.columns}
    )


def application_rules(applications: DataFrame) -> dict[str, Column]:
    """Rules on the numeric form; a null anywhere fails its column's rule."""
    rules = {f"{c}_present": F.col(c).isNotNull() for c in applications.columns}
    rules["age_range"] = F.col("age").between(18, 100)
    rules["bmi_range"] = F.col("bmi").between(15, 50)
    rules["charges_positive"] = F.col("charges") > 0
    if "children" in applications.columns:
        rules["children_range"] = F.col("children").between(0, 10)
    return rules


def validate_applications(applications: DataFrame) -> DataFrame:
    """Numbers first, then the rules, then the categories."""
    numeric = to_numbers(applications)
    valid = numeric
    for rule in application_rules(numeric).values():
        valid = valid.filter(rule)
    return normalize_categories(valid)


def dense_ids(frame: DataFrame, order: list[str], name: str) -> DataFrame:
    """Consecutive numbers from 0 by ``order``, without a single-task sort.

    Rows are range-partitioned and sorted once into checkpoint storage; each partition then
    adds the count of the partitions before it. Only those counts meet in one task.
    """
    shared_dir(frame.sparkSession)
    spread = [*[F.col(c) for c in order], F.xxhash64(*frame.columns)]
    ordered = frame.repartitionByRange(*spread).sortWithinPartitions(*spread).checkpoint()
    local = F.monotonically_increasing_id()
    numbered = ordered.withColumn("_part", F.shiftright(local, 33)).withColumn(
        "_at", local.bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition, so the broadcast is bounded by the number of tasks.
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_at"))
        .drop("_part", "_at", "_offset")
    )


def backfill(
    applications: DataFrame, as_of: datetime | None = None, order: list[str] | None = None
) -> DataFrame:
    """Add the absent required and optional columns with their defaults.

    An absent ``customer_id`` becomes ``CUST_`` and the row's number by ``order``, which a
    streaming frame cannot have; its rows need their own identifiers.
    """
    filled = applications
    if "customer_id" not in filled.columns:
        numbered = dense_ids(filled, order or filled.columns, "_row")
        digits = F.greatest(F.lit(6), F.length(F.col("_row").cast("string")))
        filled = numbered.withColumn(
            "customer_id", F.concat(F.lit("CUST_"), F.lpad(F.col("_row").cast("string"), digits, F.lit("0")))
        ).drop("_row")
    absent = [c for c in REQUIRED if c not in filled.columns]
    kinds = {"age": "int", "bmi": "double", "children": "int", "charges": "double"}
    filled = filled.withColumns(
        {c: F.lit(None).cast(kinds.get(c, "string")) for c in absent}
    )
    moment = F.current_timestamp() if as_of is None else F.lit(as_of)
    defaults = {
        "medical_history": F.lit("none"),
        "employment_status": F.lit("unknown"),
        "annual_income": F.col("charges") * 4.0,
        "application_date": moment.cast("timestamp_ntz"),
    }
    return filled.withColumns({c: v for c, v in defaults.items() if c not in filled.columns})


def expected_charges(noise: Column | None = None) -> Column:
    """Charge model over numeric age, bmi, children and the smoker flag; at least 500."""
    bmi_part = (F.col("bmi") - 25.0) * 50.0
    total = (
        F.lit(1000.0)
        + F.col("age") * 20.0
        + F.when(bmi_part.isNotNull(), F.greatest(F.lit(0.0), bmi_part))
        + F.when(F.col("smoker") == "yes", F.lit(20000.0)).otherwise(F.lit(0.0))
        + F.col("children") * 500.0
    )
    if noise is not None:
        total = total + noise
    return F.when(total.isNotNull(), F.greatest(F.lit(500.0), total))


def with_expected_charges(applications: DataFrame) -> DataFrame:
    """Modelled charges and how far the actual ones are from them."""
    return applications.withColumn("expected_charges", expected_charges()).withColumn(
        "charge_gap", F.col("charges") - F.col("expected_charges")
    )


def medical_history() -> Column:
    """Conditions joined by ``', '``, or ``none``."""
    found = items_where(
        [
            (F.col("smoker") == "yes", F.lit("smoker")),
            (F.col("bmi") > 30, F.lit("obesity")),
            (F.col("age") > 60, F.lit("senior")),
        ]
    )
    return F.when(F.size(found) == 0, F.lit("none")).otherwise(F.array_join(found, ", "))


def with_features(applications: DataFrame) -> DataFrame:
    """Encoded categories, bmi band, risk score and income ratio.

    Codes are alphabetical positions. The risk score adds one point each for smoking,
    obesity and age over 60.
    """
    bmi = F.col("bmi")
    band = (
        F.when(bmi < 18.5, "underweight")
        .when(bmi < 25, "normal")
        .when(bmi < 30, "overweight")
        .when(bmi.isNotNull(), "obese")
    )

    def code(column: Column, values: list[str]) -> Column:
        place = F.array_position(F.lit(sorted(values)), column)
        return F.when(place > 0, (place - 1).cast("int"))

    def point(test: Column) -> Column:
        return F.when(test, F.lit(1)).otherwise(F.lit(0))

    return applications.withColumn("bmi_category", band).withColumns(
        {
            "gender_encoded": code(F.col("gender"), ["female", "male"]),
            "smoker_encoded": code(F.col("smoker"), ["no", "yes"]),
            "region_encoded": code(
                F.col("region"), ["northeast", "northwest", "southeast", "southwest"]
            ),
            "bmi_category_encoded": code(
                F.col("bmi_category"), ["normal", "obese", "overweight", "underweight"]
            ),
            "risk_score": point(F.col("smoker") == "yes") + point(bmi > 30) + point(F.col("age") > 60),
            "income_to_charges_ratio": F.try_divide(
                F.col("annual_income").cast(T.DoubleType()), F.col("charges")
            ),
        }
    )
