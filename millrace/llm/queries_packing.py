"""op4: all documents packed into sequences of 1024 tokens."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import spread

from .bpe import default_vocab
from .packing import pack_documents

CAPACITY, END_ID = 1024, 2


def packed(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, default_vocab(), END_ID, CAPACITY).withColumn("piece", F.col("piece").cast("int"))


def op4_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 tokens. A null text is its end token alone; repeated rows and null
    ids are documents of their own; no documents, no rows."""
    return packed(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")))
