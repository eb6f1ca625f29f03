"""op10: SimHash near-duplicates of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import spread

from .simhash import fingerprint_hex, near_duplicates


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, links and component. Null and empty texts have fingerprint 0 and link; repeated
    rows count each; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return near_duplicates(docs).select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "n_near", "component_id")
