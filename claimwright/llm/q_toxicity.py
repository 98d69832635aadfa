"""op8: the toxicity of every document, learned from two thirds of the labels."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.toxicity import fit, score


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def document_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.filter(~_held_out()))
    return score(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op8_document_toxicity": (document_toxicity, None)}
