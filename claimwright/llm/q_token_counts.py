"""op9: tokens of every document before and after masking what it holds of numbers and addresses.

The edits come from the documents themselves: each mail address and each run of nine or more digits
is replaced by a mark, from the last to the first, so that the offsets of the others stay valid.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm.token_counts import Vocabulary, apply_listed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PERSONAL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]{9,}"
MARK = "<masked>"


def masking_edits(text):
    """Edits that replace every match of ``PERSONAL``, the last one first."""
    hits = F.regexp_extract_all(text, F.lit(PERSONAL), F.lit(0))
    gaps = F.split(text, PERSONAL, -1)
    kind = "array<struct<seq:bigint,start:bigint,stop:bigint,new:string>>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {kind})").alias("edits"))

    def place(state, step):
        start = state["at"] + F.char_length(step["gap"])
        stop = start + F.char_length(step["hit"])
        edit = F.struct(
            (-start).alias("seq"), start.alias("start"), stop.alias("stop"), F.lit(MARK).alias("new")
        )
        edits = F.when(step["hit"].isNull(), state["edits"]).otherwise(
            F.concat(F.array(edit), state["edits"])
        )
        return F.struct(F.coalesce(stop, start).alias("at"), edits.alias("edits"))

    steps = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"))
    return F.when(text.rlike(PERSONAL), F.aggregate(steps, begin, place)["edits"])


def document_tokens(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edits = docs.select("doc_id", "text", masking_edits(F.col("text")).alias("edits"))
    return apply_listed(edits, "edits", Vocabulary.read(vocabulary, PATTERN))


QUERIES = {"op9_document_tokens": (document_tokens, None)}
