"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

OUTPUT = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null text: 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """(source, n_docs, source_size) -> the same with ``target``: each source's words in the mix.

    Sources by code point, null last, have the ``weights`` in turn and share all words by them; one
    stops at ``limit`` times its size and the rest is shared again until none is above. That fixed
    point is min(limit * size, level * weight) for one level, which is raised here round by round from
    sums over the sources, so no source list is held on the driver.
    """
    # code-point rank without one task for all sources: sort in ranges, count by range, add what lies before
    ordered = stage(
        sizes.withColumn("missing", F.col("source").isNull()).repartitionByRange("missing", "source").sortWithinPartitions("missing", "source")
        .withColumn("pid", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sources",
    )
    counts = sorted((r["pid"], r["count"]) for r in ordered.groupBy("pid").count().collect())  # at most a row a partition
    ahead = list(accumulate((n for _, n in counts), initial=0))
    before = ordered.sparkSession.createDataFrame([(pid, n) for (pid, _), n in zip(counts, ahead)], "pid int, before long")
    turn = F.pmod(F.col("before") + F.col("pos"), F.lit(len(weights)))
    ranked = ordered.join(before, "pid").select(
        "source", "n_docs", "source_size", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int")).alias("w")
    )
    ranked = stage(ranked, "ranked")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.col("source_size").cast("double") * limit
    full, share = 0, ranked.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    while True:
        level = F.col("w") * F.lit((total - full) / share if share else 0.0)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(level > cap, F.col("source_size") * limit)), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(level <= cap, F.col("w"))), F.lit(0)).alias("share"),
        ).first()
        if (row["full"], row["share"]) == (full, share):
            return ranked.select("source", "n_docs", "source_size", F.least(cap, level).alias("target"))
        full, share = row["full"], row["share"]


def offset_of(source: Column, seed: str) -> Column:
    """One random number in [0, 1) for a source: the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(
    df: DataFrame, size: Column, weights: Sequence[int] = (5, 2, 1), limit: int = 3, seed: str = "mix:", source_col: str = "source", id_col: str = "doc_id", tie: Column | None = None,
) -> DataFrame:
    """``df`` with size, source_size, target, copies and taken (copies times size), replacing such columns.

    Systematic sampling: in each source, rows in order of size each expect target / source_size
    copies; with one random offset added to the prefix sum, a row is taken once for each integer that
    it crosses. So copies differ by at most one in a source, never exceed ``limit``, and in order of
    size the words taken miss the target by less than the largest row. The prefix sum is a rank:
    rows are sorted in ranges of (source, size, id, tie), each range counts its rows by source, and a
    range adds what came before it, so a source that holds most rows is spread over many tasks.
    Rows with equal keys are interchangeable unless ``tie`` (a hash of the content) orders them.
    Sources with no words take none. A null source is a source of its own. Empty tables stay empty.
    """
    row, tie = "__mr_row", F.lit(0) if tie is None else tie
    kept = [c for c in df.columns if c.lower() not in OUTPUT]
    table = stage(df.withColumns({"__mr_size": F.coalesce(size.cast("long"), F.lit(0)), "__mr_tie": tie, row: F.monotonically_increasing_id()}).drop(*[c for c in df.columns if c not in kept]), "mix")
    order = ["__mr_miss", source_col, "__mr_size", id_col, "__mr_tie", row]
    rows = table.select(source_col, "__mr_size", id_col, "__mr_tie", row, F.col(source_col).isNull().alias("__mr_miss"))
    rows = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("__mr_pid", F.spark_partition_id()).withColumn("__mr_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranks",
    )
    source = F.col(source_col)
    runs = stage(rows.groupBy("__mr_pid", source.alias("source")).agg(F.min("__mr_pos").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("__mr_size").alias("words")), "runs")
    sums = runs.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum("words").alias("source_size"))
    aims = targets(sums, weights, limit)
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("__mr_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.withColumn("ahead", ahead).alias("r").join(aims.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    starts = starts.select(
        F.col("__mr_pid").alias("pid"), F.col("r.source").alias("src"), (F.col("ahead") - F.col("first")).alias("shift"), F.col("t.source_size").alias("source_size"), "target",
        F.when(F.col("t.source_size") > 0, F.col("target") / F.col("t.source_size")).alias("rate"), offset_of(F.col("r.source"), seed).alias("offset"),
    )
    found = rows.join(starts, (F.col("__mr_pid") == F.col("pid")) & source.eqNullSafe(F.col("src")))
    rank, rate, u = F.col("__mr_pos") + F.col("shift"), F.col("rate"), F.col("offset")
    copies = F.when(F.col("source_size") > 0, F.floor(rate * (rank + 1) + u) - F.floor(rate * rank + u)).otherwise(0)
    mixed = [F.col("__mr_size").alias("size"), "source_size", "target", F.least(copies, F.lit(limit)).cast("long").alias("copies")]
    if set(kept) <= {source_col, id_col}:
        out = found.select(*kept, *mixed)
    else:
        out = table.join(found.select(row, *mixed), row).select(*[F.col(f"`{c}`") for c in kept], *OUTPUT[:4])
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def take(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row of ``mix``'s result as often as it is taken."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("__mr_copy")
    return mixed.where("copies > 0").select(*[F.col(f"`{c}`") for c in columns], copies).drop("__mr_copy")
