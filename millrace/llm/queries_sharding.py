"""op1: all documents in 24 shards by histogram sort."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import spread

from .sharding import histogram_shards

SHARDS = 24


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard by the law ``bytes``, order of doc_id. A null text has size 8, like an empty one; equal
    rows lie next to each other; no documents, no rows."""
    text = F.coalesce("text", F.lit(""))
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("tie")
    )
    sharded = histogram_shards(docs, "doc_id", F.col("size"), F.col("tie"), SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _crc_table() -> list[int]:
    rows = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        rows.append(c)
    return rows


#: A shard ends at the row's edge nearest j / 24 of all bytes, so a row's own middle decides. The CRC is added up byte by byte.
OP1_SQL = f"""
WITH steps AS (
  SELECT CAST({_crc_table()} AS BIGINT[]) AS t
), sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents
), placed AS (
  SELECT doc_id, size, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS text_crc32,
         CAST(sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto, CAST(sum(size) OVER () AS BIGINT) AS total
  FROM sized, steps
), sharded AS (
  SELECT doc_id, size, text_crc32, CAST(least(({SHARDS} * (2 * upto - size)) // (2 * total), {SHARDS - 1}) AS INT) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM sharded
"""
