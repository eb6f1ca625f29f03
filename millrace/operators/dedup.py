"""Exact deduplication that keeps the first row of each text, and plain set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ORDER, _KEY = "__mr_order", "__mr_text"


def arrival_order() -> Column:
    """Order of arrival, for a frame without a key to order by; take it right at the scan."""
    return F.monotonically_increasing_id()


def dedup_keep_first(df: DataFrame, text_column: str = "text", order: Column | None = None) -> DataFrame:
    """One row of each text, the least by ``order`` (arrival if not given); null is a text like any other.

    An aggregate on the text's SHA-256, not a window: the least row is taken map-side, so a text that
    most rows share costs a row a task, no group is ever collected, and texts travel once.
    """
    keyed = df.withColumn(_ORDER, order if order is not None else arrival_order())
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = keyed.groupBy(F.sha2(F.col(f"`{text_column}`").cast("binary"), 256).alias(_KEY)).agg(F.min_by(rest, _ORDER).alias("row"))
    return first.select("row.*")


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns, repeats kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def difference(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` isn't in ``other``."""
    return df.join(other.select(on).distinct(), on, "left_anti")


def sample_rows(df: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    """``n`` rows that depend on ``key`` and ``seed`` alone: the least MD5s."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)
