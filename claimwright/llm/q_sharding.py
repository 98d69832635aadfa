"""op13: the shard and slot of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.sharding import assign

SHARDS = 8


def sharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# CRC-32, the tie hashes and the search for medians are beyond the SQL; a test holds a plain version.
QUERIES = {"op13_sharded_documents": (sharded_documents, None)}
