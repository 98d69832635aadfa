"""op2: passages of 50 words or more that several documents hold."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.suffixes import repeated_passages


def repeated_document_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with such passages: their number, words, spans, partners and components.

    Spans of two documents share a component exactly if a chain of shared passages joins them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spans = repeated_passages(docs)
    return spans.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.sum(F.col("last") - F.col("first")).cast("long").alias("n_words"),
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
        F.sort_array(F.collect_set("partner")).alias("partners"),
        F.sort_array(F.collect_set("component")).alias("components"),
    )


QUERIES = {"op2_repeated_passages": (repeated_document_passages, None)}
