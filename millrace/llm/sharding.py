"""Sharding by histogram sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .histogram import KEYS, WEIGHT, Splitters, find_splitters, keyed, place
from .shared import drop_names

#: Rows that one task sorts on average; fewer for wide rows.
TASK_ROWS = 1 << 22


def _placed(cuts: Splitters, fine: int) -> Column:
    """Struct (part, start): a row's part, and how many rows of its shard lie in the parts before."""
    keys, starts = cuts.keys, np.array([r - cuts.rows[p - p % fine] for p, r in enumerate(cuts.rows)], np.int64)

    def run(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        parts = place(keys, *[x.to_numpy(zero_copy_only=False) for x in (a, b, c)])
        return pa.StructArray.from_arrays([pa.array(parts, pa.int32()), pa.array(starts[parts], pa.int64())], names=["part", "start"])

    run.__annotations__ = dict.fromkeys(("a", "b", "c", "return"), pa.Array)
    return F.arrow_udf(run, "part int, start long")(*KEYS)


def histogram_shards(df: DataFrame, key: str, size: Column, tie: Column, shards: int, tolerance: float = 0.0, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in ``shards`` shards of near equal size, sorted by ``key`` across them.

    Adds ``shard`` (from 0) and ``slot`` (place in the shard, gapless from 0), replacing columns of
    those names. A shard ends at the row's edge nearest its even share, or, with a ``tolerance``, at the first
    one found within so much of a share. Order is key (null first), tie, arrival, so repeated rows and a key that
    holds much of the table are divided like any other rows. Shards of over ``task_rows`` rows on average are
    cut finer, so a task's part stays bounded whatever the number of shards. The rows are exchanged
    once, straight to their parts. A null size counts nothing; an empty table stays empty.
    """
    table = keyed(df, key, size, tie)
    fine = max(1, -(-table.count() // (shards * task_rows)))
    cuts = find_splitters(table, shards * fine, tolerance / fine)
    part = "__mr_part"
    at = table.withColumn("__mr_at", _placed(cuts, fine)).select("*", F.col("__mr_at.part").alias(part), F.col("__mr_at.start").alias("__mr_start")).drop("__mr_at")
    moved = at.repartitionById(shards * fine, F.col(part))
    rank = F.row_number().over(Window.partitionBy(part).orderBy(*KEYS)) - 1
    placed = moved.withColumn("__mr_slot", F.col("__mr_start") + rank)
    own = drop_names(placed, (*KEYS, WEIGHT, part, "__mr_start", "__mr_slot", "shard", "slot")).columns
    return placed.select(*[F.col(f"`{c}`") for c in own], F.floor(F.col(part) / fine).cast("int").alias("shard"), F.col("__mr_slot").alias("slot"))
