"""op2: licences in all documents."""

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.io import spread

from .licenses import scan_licenses


def op2_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licence passages of every document. A null text is empty: no words, score 0; repeated rows get
    equal results; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    return scan_licenses(docs).drop("text", "license_spans")
