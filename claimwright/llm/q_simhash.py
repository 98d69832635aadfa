"""op6: SimHash near duplicates of all documents. XXH64 is not in the oracle's SQL."""

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm.simhash import near_duplicates


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_simhash_near_dedup": (near_duplicate_documents, None)}
