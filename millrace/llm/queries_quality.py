"""op5: quality rules over all documents."""

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.io import spread

from .quality import quality_rules


def op5_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, fertility and verdict of every document. Null and empty texts have no words and fail; repeated
    rows are measured alike; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text", "lang")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(docs).select(*base, "n_letterless", "n_tokens", "chars_per_token", "byte_share", "entropy", "script")
