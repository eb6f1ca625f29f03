"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (a, root) for each node of ``edges`` (a, b: long) that isn't itself the least of its component.

    Minima are aggregated map-side before they shuffle, so a node with many neighbours is one row a
    task; joins against them are left to adaptive skew handling. Each round is staged in the shared
    folder. Rounds end when one changes nothing: O(log^2 n), in practice 2 to 5. Self-loops and
    repeated edges are ignored; an empty table gives an empty table; null ends are dropped.
    """
    now = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = stage(_small_star(_large_star(now)).where("a <> b").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first()
        if seen == mark:
            return now.select("a", F.col("b").alias("root"))
        mark = seen
