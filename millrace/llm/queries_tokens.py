"""op3: all documents as token ids in plane files, read back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import spread

from .bpe import default_vocab
from .planes import read_tokens, write_tokens
from .shared import new_path

END_ID = 2


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids by the files that hold them. A null text is its end token alone; repeated rows follow each
    other, null ids come first; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    files = write_tokens(docs, new_path(spark, "tokens"), default_vocab(), END_ID)
    return read_tokens(files).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
