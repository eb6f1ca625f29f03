"""The corpus pipeline: quality rules, near-dedup, secret redaction, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. ``run`` writes each stage's rows as Parquet and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.mixing import mix, take, word_count
from millrace.llm.queries_mixing import LIMIT, SEED, WEIGHTS
from millrace.llm.queries_packing import packed
from millrace.llm.quality import quality_rules
from millrace.llm.secrets import redacted
from millrace.llm.shared import set_aside
from millrace.llm.simhash import keep_one
from millrace.sources.io import spread
from millrace.sources.staging import new_path, remove, scratch

#: Near copies: eight fingerprints a document, of which one pair lies within 3 bits.
COPY_VIEWS, COPY_RADIUS = 8, 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go."""
    rows, back = set_aside(docs, ("text", "lang"))
    return quality_rules(rows).where("kept").select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of each group of near copies; a null id stays where its group has no other.

    Near means within COPY_RADIUS bits in any of COPY_VIEWS fingerprints of the distinct words. Null and
    empty texts are one group, repeated rows are copies; an empty table stays empty.
    """
    rows, back = set_aside(docs, ("doc_id", "text"))
    return keep_one(rows, radius=COPY_RADIUS, views=COPY_VIEWS).select(*back)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by the secret's kind; n_chars follows the text, null with it.

    An empty text has none; repeated rows are treated alike; an empty table stays empty.
    """
    clean = docs.withColumn("text", redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it.

    A null source is a source of its own; null and empty texts have no words and cost nothing, ties and
    repeated rows are ordered by content; an empty table stays empty.
    """
    rows, back = set_aside(docs, ("doc_id", "text", "source"))
    mixed = mix(rows, word_count(F.col("text")), WEIGHTS, LIMIT, SEED, tie=F.xxhash64("text"))
    return take(mixed, rows.columns).select(*back)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 1024 tokens.

    A null or empty text is its end token alone; repeated rows and null ids are documents of their own;
    an empty table gives no piece.
    """
    return packed(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("secret_scan", secrets), ("source_mix", mixing), ("best_fit_packing", packing)]

#: Tokenizers, fingerprints and lexing have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage staged goes when its rows are written, and they when the next stage's are."""
    docs, before = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), None
    for name, function in STAGES:
        path = new_path(spark, name)
        with scratch():
            rows = function(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            remove(before)
        before = path
    return docs
