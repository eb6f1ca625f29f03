"""op8: all documents mixed by source to the weights 5, 2, 1 in turn."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.io import spread

from .mixing import mix, word_count

WEIGHTS, LIMIT, SEED = (5, 2, 1), 3, "mix:"


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix. A null text has no words, a null source is a source; ties go by size and
    doc_id; no documents, no rows."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mix(docs.select("doc_id", "source", "words"), F.col("words"), WEIGHTS, LIMIT, SEED).select("doc_id", "size", "source_size", "target", "taken")


#: The fixed point in closed form: by cap for its weight, the first sources stop at their caps; the level
#: is that of the first prefix of them beyond which none is above.
OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sources
), prefixes AS (
  SELECT *, CAST(source_size AS DOUBLE) * 3 / w AS full_at,
         coalesce(sum(source_size * 3) OVER p, 0) AS capped, sum(w) OVER (ORDER BY CAST(source_size AS DOUBLE) * 3 / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share,
         sum(source_size) OVER () AS total
  FROM weighed
  WINDOW p AS (ORDER BY CAST(source_size AS DOUBLE) * 3 / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(CAST(total - capped AS DOUBLE) / CAST(share AS DOUBLE), full_at) AS level FROM prefixes
  WHERE CAST(total - capped AS DOUBLE) / CAST(share AS DOUBLE) <= full_at
), aims AS (
  SELECT source, source_size, least(CAST(source_size AS DOUBLE) * 3, w * level) AS target,
         CAST(('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM weighed, level
), ranked AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, a.u, a.target / a.source_size AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS r
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size > 0 THEN CAST(least(floor(rate * (r + 1) + u) - floor(rate * r + u), 3) AS BIGINT) * size ELSE 0 END AS taken
FROM ranked
"""
