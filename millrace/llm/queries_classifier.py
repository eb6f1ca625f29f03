"""op7: quality scores of all documents by a factorisation machine."""

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.io import spread

from .fm import score_quality, train


def op7_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score. A null or empty text has one too; repeated rows score alike; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).drop("text")
