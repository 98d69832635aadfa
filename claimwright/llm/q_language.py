"""op3: the language of every document, learned from four fifths of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.language import fit, identify


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(~_held_out()))
    return identify(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op3_document_languages": (document_languages, None)}
