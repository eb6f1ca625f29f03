"""Best-fit packing by hierarchical residual packing: local best fit, then underfull bins as items up a tree."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .shared import stage

#: Bins with at most this much room left count as full and leave the tree.
SLACK = 4
#: Tasks of one round that feed one task of the next, and items that are packed at once (a task of the first round has up to twice as many).
FAN_IN, TASK_ITEMS = 8, 200_000


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing of sizes from 1 to ``capacity``: each item's bin and offset, and the bins' fill.

    Open bins are kept by residual; a bit mask of the residuals that occur finds the tightest one that
    fits in a few machine operations.
    """
    bins, offsets, fill = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins, offsets, fill


def pieces(df: DataFrame, vocab_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: id, piece, start, length, ids_crc32.

    Only documents longer than that are cut; all of their pieces but the first are whole.
    """

    def cut(texts: pa.Array) -> pa.Array:
        enc = encoder(vocab_path)
        end = enc.pack([end_id])
        lists, lengths, crcs = [0], [], []
        for k in range(0, len(texts), 512):
            for ids in enc.encode([t or "" for t in texts.slice(k, 512).to_pylist()]):
                words = memoryview(np.frombuffer(ids + end, f"<u{enc.width}").astype("<u4").tobytes())
                n = len(words) // 4
                at, stop = 0, (n - 1) % capacity + 1
                while at < n:
                    lengths.append(stop - at)
                    crcs.append(zlib.crc32(words[4 * at : 4 * stop]))
                    at, stop = stop, stop + capacity
                lists.append(len(lengths))
        items = pa.StructArray.from_arrays([pa.array(lengths, pa.int32()), pa.array(crcs, pa.int64())], names=["length", "crc"])
        return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), items)

    cut.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    found = F.arrow_udf(cut, "array<struct<length:int,crc:bigint>>").asNondeterministic()(F.col(text_col))
    rows = df.select(F.col(id_col).alias("id"), found.alias("found")).select("id", F.posexplode("found").alias("piece", "p"), F.element_at("found", 1)["length"].alias("first"))
    start = F.when(F.col("piece") > 0, F.col("first") + (F.col("piece") - 1) * capacity).otherwise(0)
    return rows.select("id", "piece", start.cast("long").alias("start"), F.col("p.length").cast("long").alias("length"), F.col("p.crc").alias("ids_crc32"))


def _pack_round(capacity: int, task_items: int, last: bool):
    """Items (item, size) of a task -> item, bin, offset, and the bin's fill, and whether it is done."""

    def packed(item: np.ndarray, size: np.ndarray):
        order = np.argsort(item, kind="stable")
        item, size = item[order], size[order]
        bins, offsets, fill = best_fit(size, capacity)
        # a bin is named by its first item, so names are unique and a retried task gives the same
        named = np.empty(len(fill), np.int64)
        first = np.flatnonzero(offsets == 0)
        named[bins[first]] = item[first]
        full = np.array(fill, np.int64)[bins]
        columns = [item, named[bins], offsets, full, full >= (0 if last else capacity - SLACK)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "bin", "offset", "fill", "done"])

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            held.append((batch.column("item").to_numpy(), batch.column("size").to_numpy()))
            count += batch.num_rows
            if count >= task_items and not last:
                yield packed(*map(np.concatenate, zip(*held)))
                held, count = [], 0
        if count:
            yield packed(*map(np.concatenate, zip(*held)))

    return run


def pack(items: DataFrame, length: Column, capacity: int, fan_in: int = FAN_IN, task_items: int = TASK_ITEMS) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: bins of at most ``capacity``, as few as can be.

    Round 0 packs each task's items, spread by hash, on their own, ``task_items`` at a time, by best-fit decreasing. Bins with at most SLACK
    room left are done. The others go on, mixed, as items of their fill to a round with ``fan_in`` times fewer
    tasks (more where those would hold over ``task_items``), until one is left or a mixed round of as many tasks
    takes away less than a hundredth of the open bins. A task never holds more than its share of items; nothing is left out, the last round's
    bins are done as they are. Lengths must be from 1 to ``capacity``. An empty table stays empty.
    """
    item = "__mr_item"
    table = stage(items.withColumn(item, F.monotonically_increasing_id()).withColumn("__mr_size", length.cast("long")), "items")
    todo = table.select(F.col(item).alias("item"), F.col("__mr_size").alias("size"))
    parts = -(-todo.count() // (2 * task_items))
    # by hash, so that every task has its share of every size, whatever the order of the input
    todo = todo.coalesce(1) if parts <= 1 else todo.repartition(parts, "item")
    schema = "item long, bin long, offset long, fill long, done boolean"
    rounds, before = [], None
    while True:
        last = parts <= 1
        found = stage(todo.mapInArrow(_pack_round(capacity, task_items, last), schema), "bins")
        rounds.append(found)
        if last:
            break
        open_bins = found.where("NOT done").groupBy("bin").agg(F.max("fill").alias("size")).withColumnRenamed("bin", "item")
        left = open_bins.count()
        fewer = max(-(-parts // fan_in), -(-left // task_items), 1)
        if not left or before is not None and fewer >= parts and left > 0.99 * before:
            break
        todo, parts, before = open_bins.repartition(fewer, "item"), fewer, left
    # from the top of the tree down, so that only the last join has the whole table
    placed = None
    for found in reversed(rounds):
        own = found.select("item", "bin", "offset")
        if placed is not None:
            up = placed.select(F.col("item").alias("bin"), F.col("bin").alias("up"), F.col("offset").alias("shift"))
            own = own.join(up, "bin", "left").select("item", F.coalesce("up", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
        placed = own
    own = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    out = table.join(placed.withColumnRenamed("item", item).withColumnRenamed("bin", "__mr_bin").withColumnRenamed("offset", "__mr_at"), item)
    return out.select(*[F.col(f"`{c}`") for c in own], F.col("__mr_bin").alias("sequence_id"), F.col("__mr_at").alias("offset"))


def pack_documents(df: DataFrame, vocab_path: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents' pieces packed: id, piece, start, length, ids_crc32, sequence_id, offset.

    Each document's ids are its text's (null: none) and ``end_id``, so none is empty. Repeated rows,
    equal ids and null ids are documents of their own.
    """
    found = pack(pieces(df, vocab_path, end_id, capacity, id_col, text_col), F.col("length"), capacity)
    return found.withColumnRenamed("id", id_col)


def sequences(packed: DataFrame, tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The packed sequences' ids: sequence_id, ids (array), from pieces and documents' ids (id, ids array).

    Needs unique ids; a sequence is one small group, bounded by its capacity.
    """
    cut = packed.join(tokens, id_col).select("sequence_id", "offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("part"))
    rows = cut.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda x: x["part"])).alias("ids"))
