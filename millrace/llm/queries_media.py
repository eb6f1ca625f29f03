"""op6: all documents stored as chunked media and read back."""

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.io import spread

from .media import read_media, settle, store_media
from .shared import new_path


def op6_chunked_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's padded bytes as a WAV file of 8-bit samples, its chunks stored once each, read back and
    verified. Null and empty texts are 64 zeros; repeated rows and null ids have a row each; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    directory = new_path(spark, "packs")
    manifests = store_media(docs, directory)
    return read_media(manifests, directory, settle(manifests, directory)).withColumnRenamed("id", "doc_id")
