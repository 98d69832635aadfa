import pytest
from pyspark.sql import functions as F

from claimwright.operators import decisions, labels, quality
from claimwright.operators import statistics as stats
from claimwright.plans import registry
from claimwright.session import attach_lookup
from claimwright.sources import derived
from claimwright.streaming import ingest


@pytest.fixture(scope="module")
def files(spark, sf_dir, tmp_path_factory):
    """The derived claims as several files, a third of them held back."""
    folder = tmp_path_factory.mktemp("claims")
    claims = labels.labelled_claims(labels.with_timing(derived.medical_claims(spark, sf_dir)))
    claims.repartition(3).write.parquet(str(folder / "now"))
    later = claims.limit(100).withColumn("patient_id", F.lit("late"))
    later.coalesce(1).write.parquet(str(folder / "later"))
    return folder


def test_restart_adds_no_duplicates(spark, files, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(str(files / "now")).repartition(3).write.parquet(str(source))
    schema = spark.read.parquet(str(source)).schema
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = ingest.file_stream(spark, str(source), schema, files_per_batch=1)
        query = ingest.ingest_claims(stream, out, checkpoint, available_now=True)
        query.awaitTermination()
        return spark.read.parquet(out)

    expected = quality.validate_claims(spark.read.parquet(str(source)))
    first = run()
    assert first.count() == expected.count()
    assert first.select("ok", "ln", "pk", "sk").exceptAll(expected.select("ok", "ln", "pk", "sk")).isEmpty()
    assert run().count() == expected.count()
    spark.read.parquet(str(files / "later")).write.mode("append").parquet(str(source))
    assert run().count() == expected.count() + 100


def test_statistics_are_per_batch(spark, files, tmp_path):
    schema = spark.read.parquet(str(files / "now")).schema
    stream = ingest.file_stream(spark, str(files / "now"), schema, files_per_batch=1)
    out = str(tmp_path / "out")
    ingest.batch_statistics(stream, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    back = spark.read.parquet(out)
    assert back.count() == spark.read.parquet(str(files / "now")).count()
    means = back.groupBy("batch").agg(F.avg("billed_amount_zscore").alias("m"), F.count("*").alias("n"))
    rows = means.collect()
    assert len(rows) == 3 and all(abs(r.m) < 1e-9 for r in rows)


def test_stored_statistics_and_decisions_on_a_stream(spark, files, tmp_path):
    batch = spark.read.parquet(str(files / "now"))
    baselines = stats.settle(stats.claim_baselines(batch))
    stream = ingest.file_stream(spark, str(files / "now"), batch.schema, files_per_batch=2)
    scored = decisions.decide(stats.with_baselines(stream, baselines))
    out = str(tmp_path / "out")
    ingest.append_stream(scored, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    expected = decisions.decide(stats.with_baselines(batch, baselines))
    columns = ["ok", "ln", "pk", "sk", "billed_amount_zscore", "approval_probability"]
    got = spark.read.parquet(out).select(columns)
    assert got.count() == batch.count()
    assert got.exceptAll(expected.select(columns)).isEmpty()


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    """The given tables as folders of several part files."""
    folder = tmp_path_factory.mktemp("tables")
    for table in ("lineitem", "orders", "customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(3).write.parquet(
            str(folder / f"{table}.parquet")
        )
    return str(folder)


@pytest.mark.parametrize(
    "stream, batch",
    [
        ("stream_claims", "validate_claims"),
        ("stream_applications", "backfill_applications"),
        ("stream_batch_statistics", "billed_zscore"),
        ("stream_screening", "screening_scores"),
        ("stream_decisions", "approval_decisions"),
    ],
)
def test_tables_of_part_files(spark, folders, stream, batch):
    runs = registry.queries()
    got, expected = runs[stream](spark, folders), runs[batch](spark, folders)
    expected = expected.select(got.columns)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).isEmpty()


def test_large_lookup_on_a_stream(spark, files, tmp_path):
    batch = spark.read.parquet(str(files / "now"))
    lookup = batch.groupBy("provider_id").agg(F.count("*").alias("n"))
    stream = ingest.table_stream(spark, str(files / "now"))
    joined = attach_lookup(stream, lookup, ["provider_id"], max_rows=5)
    out = str(tmp_path / "out")
    ingest.append_stream(joined, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    expected = attach_lookup(batch, lookup, ["provider_id"]).select("ok", "ln", "pk", "sk", "n")
    got = spark.read.parquet(out).select("ok", "ln", "pk", "sk", "n")
    assert got.count() == batch.count() and got.exceptAll(expected).isEmpty()
