import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimwright.operators import applications, quality
from claimwright.plans import quality as plans
from claimwright.sources import catalog, published, readers, schemas, sinks


def test_schema_widths():
    widths = {t: len(schemas.fields(t)) + 1 for t in schemas.TABLES}
    # The applications table also had an identity column in its old store.
    assert widths == {
        "raw_applications": 13,
        "medical_claims": 37,
        "bpo_claims_processing": 54,
        "bpo_claims_training": 53,
    }


def test_conform_types_and_absent_columns(spark):
    frame = spark.createDataFrame([("c1", 10.125, True)], "claim_id string, billed_amount double, is_rejected boolean")
    stored = schemas.conform(frame, "medical_claims")
    kinds = dict(stored.dtypes)
    assert kinds["billed_amount"] == "decimal(10,2)" and kinds["billed_amount_zscore"] == "decimal(10,6)"
    assert stored.columns[-1] == "created_date"
    row = stored.first()
    assert str(row.billed_amount) == "10.13" and row.patient_id is None


def test_create_verify_and_profile(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS checked LOCATION '{tmp_path}/checked'")
    schemas.create_tables(spark, "checked", str(tmp_path / "checked"))
    schemas.create_tables(spark, "checked", str(tmp_path / "checked"))
    names = [f"checked.{t}" for t in schemas.TABLES] + ["checked.nothing"]
    found = {r.table_name: (r.table_exists, r.columns) for r in catalog.verify_tables(spark, names).collect()}
    assert found["checked.medical_claims"] == (True, 37)
    assert found["checked.nothing"] == (False, 0)
    assert readers.read_table(spark, "checked.raw_applications").count() == 0
    profile = catalog.profile_columns(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"))
    assert [tuple(r) for r in profile.orderBy("position").collect()] == [
        (1, "a", "int", 2),
        (2, "b", "string", 1),
    ]
    assert catalog.sample_rows(spark.range(20)).count() == 5


def test_append_refuses_empty(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(3)
    assert sinks.append_rows(rows.filter("id > 9"), target) is False
    assert sinks.append_rows(rows, target) and sinks.append_rows(rows, target)
    assert spark.read.parquet(target).count() == 6


def test_reconcile_finds_differences(spark):
    ours = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    theirs = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    row = sinks.reconcile(ours, theirs, ["k"]).first()
    assert (row.source_rows, row.target_rows) == (4, 3)
    assert (row.missing_keys, row.extra_keys, row.differing_keys, row.matches) == (1, 1, 3, False)
    assert sinks.reconcile(ours, ours, ["k"]).first().matches is True


def test_partitioned_write_prunes(spark, tmp_path):
    rows = spark.sql("SELECT DATE'2020-01-15' AS service_date, 1 AS x UNION ALL SELECT DATE'2020-02-15', 2")
    sinks.write_table(rows, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m")).filter("service_month = '2020-02'")
    assert back.count() == 1 and "PartitionFilters: [isnotnull" in back._jdf.queryExecution().toString()


def test_month_write_gathers_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "CAST(date_add(DATE'2020-01-01', CAST(id % 60 AS INT)) AS DATE) AS service_date", "id"
    )
    sinks.write_table(rows.repartition(12), str(tmp_path / "m"))
    for month in ("2020-01", "2020-02"):
        assert len(list((tmp_path / "m" / f"service_month={month}").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "m")).count() == 4000


def test_union_of_batches(spark):
    one = spark.createDataFrame([(1, "a")], "id int, note string")
    two = spark.createDataFrame([(2,)], "id int")
    got = sinks.union_batches([one, two]).orderBy("id").collect()
    assert [(r.id, r.note) for r in got] == [(1, "a"), (2, None)]


def test_csv_and_fallback(spark, tmp_path):
    path = str(tmp_path / "apps")
    spark.createDataFrame(
        [(30, "male", 22.5, 1, "no", "northeast", 100.0)], readers.PUBLIC_APPLICATIONS
    ).write.option("header", True).csv(path)
    assert readers.read_applications(spark, path).count() == 1
    other = spark.range(4)
    assert readers.read_applications(spark, str(tmp_path / "none"), other).count() == 4
    with pytest.raises(ValueError):
        readers.read_applications(spark, str(tmp_path / "none"))


def test_fill_and_dates(spark):
    frame = spark.createDataFrame([(None, None, None, "2020-01-02 03:04:05"), (1, "a", True, "bad")], "n int, s string, b boolean, d string")
    parsed = readers.parse_dates(frame, ["d", "absent"])
    assert [r.d is None for r in parsed.collect()] == [False, True]
    filled = readers.fill_missing(frame, keep=["s"]).first()
    assert (filled.n, filled.s, filled.b) == (0, None, False)
    assert readers.nan_to_null(spark.sql("SELECT double('NaN') AS x")).first().x is None


def test_application_validation(spark):
    schema = "customer_id string, age int, sex string, bmi string, smoker string, region string, charges double"
    rows = [
        ("a", 18, "MALE", "15", "Yes", "Northeast", 0.01),
        ("b", 17, "MALE", "20", "Yes", "Northeast", 5.0),
        ("c", 100, "Female", "50", "NO", "Southwest", 5.0),
        ("d", 40, "Female", "x", "NO", "Southwest", 5.0),
        ("e", 40, "Female", "NaN", "NO", "Southwest", 5.0),
        (None, 40, "Female", "30", "NO", "Southwest", 5.0),
    ]
    kept = applications.validate_applications(spark.createDataFrame(rows, schema))
    assert sorted(r.customer_id for r in kept.collect()) == ["a", "c"]
    assert "gender" in kept.columns and {r.smoker for r in kept.collect()} == {"yes", "no"}


def test_constraint_report(spark):
    frame = spark.createDataFrame(
        [("c", None, "x" * 11, 1e9), ("d", "p", "ok", 1.0)],
        "claim_id string, patient_id string, primary_diagnosis_code string, billed_amount double",
    )
    found = {
        (r.column_name, r.rule): r.violations
        for r in quality.quality_report(frame, "medical_claims").collect()
    }
    assert found["patient_id", "not_null"] == 1
    assert found["primary_diagnosis_code", "max_length"] == 1
    assert found["billed_amount", "range"] == 1
    assert found["claim_id", "not_null"] == 0


def test_denial_actions(spark):
    reasons = spark.createDataFrame([("incorrect_coding",), ("other",)], "rejection_reason string")
    found = {r.rejection_reason: r.denial_action for r in quality.with_denial_action(reasons).collect()}
    assert found == {"incorrect_coding": "Review coding with certified coder", "other": None}


def test_medical_history_and_charges(spark):
    frame = spark.createDataFrame(
        [(65, 31.0, 2, "yes"), (30, 20.0, 0, "no"), (None, 20.0, 0, "no")],
        "age int, bmi double, children int, smoker string",
    )
    row = frame.select(applications.medical_history().alias("h"), applications.expected_charges().alias("c")).collect()
    assert [r.h for r in row] == ["smoker, obesity, senior", "none", "none"]
    assert [r.c for r in row] == [1000 + 1300 + 300 + 20000 + 1000, 1600.0, None]
    assert frame.select(F.lit(1)).count() == 3


def test_long_text_is_refused(spark):
    from claimwright.sources import schemas

    frame = spark.createDataFrame([("x" * 60,)], "claim_id string")
    with pytest.raises(Exception, match="claim_id is longer than 50"):
        schemas.conform(frame, "medical_claims").collect()


def test_batches_replace_themselves_and_empty_ones_are_refused(spark, tmp_path):
    from claimwright.sources import sinks

    path = str(tmp_path / "table")
    rows = spark.range(10)
    assert sinks.append_batch(rows, path, "a") == 10
    assert sinks.append_batch(rows.filter("id < 4"), path, "b") == 4
    assert sinks.append_batch(rows.filter("id < 7"), path, "a") == 7
    with pytest.raises(ValueError):
        sinks.append_batch(rows.filter("id < 0"), path, "c")
    assert published.read_published(spark, path).count() == 11


def test_a_failure_before_publishing_leaves_the_old_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    published.publish(spark.range(5), path, "a")
    reader = published.read_published(spark, path)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(published, "_replace", broken)
        with pytest.raises(OSError):
            published.publish(spark.range(9), path, "a")
    assert published.read_published(spark, path).count() == reader.count() == 5
    assert published.publish(spark.range(7), path, "a") == 7
    assert reader.count() == 5 and published.read_published(spark, path).count() == 7
    assert published.read_published(spark, path, version=1).count() == 5
    # One version is given out once: a writer that has not seen it is refused.
    with pytest.raises(RuntimeError):
        published._replace(spark, path, [("b", "_data/none", 1)], 1)
    assert published.sweep(spark, path, keep=1) == 2 and published.read_published(spark, path).count() == 7
    assert published.withdraw(spark, path, "a") and not published.withdraw(spark, path, "a")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)


def test_a_copy_goes_on_with_what_is_left(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "copy")
    source = spark.range(100).withColumn("id", F.when(F.col("id") != 50, F.col("id")))
    parts, publish = [], published.publish

    def third_fails(frame, path, batch, table):
        if len(parts) == 2:
            raise OSError("lost")
        parts.append((batch, publish(frame, path, batch, table)))

    with monkeypatch.context() as patched:
        patched.setattr(published, "publish", third_fails)
        with pytest.raises(OSError):
            published.copy_ranges(source, path, "id", [10, 60, 60, 80])
    assert parts == [("id first", 11), ("id>=10", 49)]
    assert published.copy_ranges(source, path, "id", [10, 60, 60, 80]) == ["id>=60", "id>=80"]
    assert published.copy_ranges(source, path, "id", [10, 60, 60, 80]) == []
    back = published.read_published(spark, path)
    assert back.drop("batch").exceptAll(source).isEmpty() and back.count() == 100


def test_reconcile_spreads_keys_over_tasks_by_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_KEYS", 50)
    source = spark.range(1000).selectExpr("if(id < 300, null, if(id < 500, 7, id)) AS k").repartition(5)
    target = sinks.copy_table(source.filter("k IS NULL OR k <> 999"), str(tmp_path / "copied"))
    found = sinks.reconcile(source, target, ["k"])
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert "20)" in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert (row.source_rows, row.target_rows, row.missing_keys, row.extra_keys, row.differing_keys) == (1000, 999, 1, 0, 1)
    assert row.matches is False


def test_csv_round_trip_stores_compressed_files(spark, sf_dir, monkeypatch):
    """All claims are written and read, in far fewer bytes than their text has."""
    written = []
    monkeypatch.setattr(sinks, "write_csv", lambda f, p, *a, w=sinks.write_csv, **k: written.append((f, p)) or w(f, p, *a, **k))
    found = plans.csv_round_trip(spark, sf_dir)
    frame, path = written[0]
    assert found.agg(F.sum("claims")).first()[0] == frame.count()
    files = [f for f in Path(path).iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < sum(len(gzip.open(f).read()) for f in files) / 3


def test_csv_keeps_odd_texts_when_compressed(spark, tmp_path):
    rows = [("a,b", 1.5), ('say "x"', None), (None, 2.0), ("\u00e9", -0.0)]
    frame = spark.createDataFrame(rows, "t string, v double")
    for kind in ("none", "gzip"):
        sinks.write_csv(frame, f"{tmp_path}/{kind}", compression=kind)
        back = readers.read_csv(spark, f"{tmp_path}/{kind}", "t string, v double")
        assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
