"""SimHash near-duplicates: exact search within a Hamming radius by sharded BK-trees."""

from __future__ import annotations

from collections import Counter
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .components import connected_components
from .shared import ascii_bytes, drop_names, stage

RADIUS = 2
#: Shards with more distinct fingerprints than this are divided; one of so few free bits can't have more.
MAX_TREE, FREE_BITS = 2048, 11
_ALL = (1 << 64) - 1
#: Odd constants that make further hashes of a hash, one a view.
_VIEWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


def _majority(hashes: np.ndarray, weights: np.ndarray | None, slice_rows: int) -> int:
    """The bits set in over half of the hashes (by weight, if given), as a signed integer."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), slice_rows):
        bits = np.unpackbits(hashes[i : i + slice_rows].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32) if weights is None else weights[i : i + slice_rows] @ bits
    total = len(hashes) if weights is None else int(weights.sum())
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprint(data: bytes, slice_rows: int = 1 << 16) -> int:
    """The 64-bit SimHash of a text's bytes by its 3-word shingles, as a signed integer; no words: 0."""
    words = data.lower().split()
    n = len(words) - 2
    if n < 1:
        if not words:
            return 0
        grams, n = [b" ".join(words)], 1
    else:
        grams = map(b" ".join, zip(words, words[1:], words[2:]))
    return _majority(np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, n), None, slice_rows)


def word_fingerprints(data: bytes, views: int, slice_rows: int = 1 << 16) -> list[int]:
    """``views`` fingerprints of a text by its distinct words, each from hashes of its own; no words: zeros.

    A word that occurs k times weighs as much as k has binary digits, so the commonest don't decide.
    """
    counts = Counter(data.lower().split())
    if not counts:
        return [0] * views
    base = np.fromiter(map(xxh64_intdigest, counts, repeat(42)), np.uint64, len(counts))
    weights = np.fromiter(map(int.bit_length, counts.values()), np.int64, len(counts))
    out = []
    for k in range(views):
        h = (base ^ np.uint64(_VIEWS[k])) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xC4CEB9FE1A85EC53)
        out.append(_majority(h ^ h >> np.uint64(29), weights, slice_rows))
    return out


class BKTree:
    """A Burkhard-Keller tree over unsigned integers under Hamming distance."""

    __slots__ = ("children", "values")

    def __init__(self, values) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for v in values:
            self.add(v)

    def add(self, value: int) -> None:
        values, children = self.values, self.children
        new = len(values)
        if new:
            at = 0
            while True:
                d = (values[at] ^ value).bit_count()
                at, here = children[at].setdefault(d, new), at
                if at == new:
                    break
        values.append(value)
        children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Places, in order of insertion, of the values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.children[at]
            if len(edges) <= 2 * radius + 1:
                todo += [k for e, k in edges.items() if -radius <= e - d <= radius]
            else:
                todo += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        return found


def _split(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` near equal runs of the given bit places."""
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]


@cache
def pairs_of_blocks(radius: int) -> tuple[int, ...]:
    """Masks of all pairs of ``radius + 2`` blocks: words within ``radius`` bits agree on one pair at least."""
    return tuple(a | b for a, b in combinations(_split(list(range(64)), radius + 2), 2))


@cache
def shard_of_path(path: tuple[int, ...], radius: int) -> tuple[int, tuple[int, ...]]:
    """The bits that a shard's words share, and the masks that a link must not agree on to be counted there.

    A path is a pair of blocks, then, for each division, one of ``radius + 1`` parts of the other bits. Two
    linked words share the first pair that they agree on and in it, divided or not, the first part; so each
    link is counted in one shard.
    """
    pairs = pairs_of_blocks(radius)
    mask, before = pairs[path[0]], list(pairs[: path[0]])
    for k in path[1:]:
        parts = _split([b for b in range(64) if not mask >> b & 1], radius + 1)
        before += parts[:k]
        mask |= parts[k]
    return mask, tuple(before)


def _path(code: int, radius: int) -> tuple[int, ...]:
    """A path from its code: the pair, then each part plus one, in base ``radius + 2``."""
    first, rest = code & 0xFF, code >> 8
    parts = []
    while rest:
        parts.append(rest % (radius + 2) - 1)
        rest //= radius + 2
    return (first, *reversed(parts))


def _child(code: int, part: int, radius: int) -> int:
    return code & 0xFF | ((code >> 8) * (radius + 2) + part + 1) << 8


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _divider(radius: int):
    """Rows of crowded shards -> the same words in each part's shard."""

    def run(batches):
        for batch in batches:
            view, code, fp, n = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("view", "code", "fp", "n")]
            for own in np.unique(code).tolist():
                at = np.flatnonzero(code == own)
                for part in range(radius + 1):
                    child = _child(own, part, radius)
                    mask = np.int64(_signed(shard_of_path(_path(child, radius), radius)[0]))
                    columns = [view[at], np.full(len(at), child, np.int64), fp[at] & mask, fp[at], n[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["view", "code", "value", "fp", "n"])

    return run


def _searcher(radius: int):
    """Shards in order -> (view, fp, near, root): links by a BK-tree of each shard, each link counted in one shard."""

    def shard_rows(code: int, fps: list[int], ns: list[int]):
        before = shard_of_path(_path(code, radius), radius)[1]
        tree = BKTree(fps)
        near, parent = [0] * len(fps), list(range(len(fps)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, v in enumerate(fps):
            for j in tree.within(v, radius):
                if j != i:
                    x = v ^ fps[j]
                    if all(x & m for m in before):
                        near[i] += ns[j]
                    if j < i and (a := find(i)) != (b := find(j)):
                        parent[max(a, b)] = min(a, b)
        for i, v in enumerate(fps):
            root = find(i)
            if near[i] or root != i:
                yield v, near[i], fps[root]

    def close(view, code, value, fp, n):
        """Rows of complete groups -> an output batch."""
        out, views = [], []
        if len(fp):
            starts = np.flatnonzero(np.r_[True, (view[1:] != view[:-1]) | (code[1:] != code[:-1]) | (value[1:] != value[:-1])])
            ends = np.r_[starts[1:], len(fp)]
            for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                rows = list(shard_rows(int(code[s]), fp[s:e].view(np.uint64).tolist(), n[s:e].tolist()))
                out += rows
                views += [int(view[s])] * len(rows)
        a, b, c = zip(*out) if out else ((), (), ())
        signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, c)]
        return pa.RecordBatch.from_arrays([pa.array(views, pa.int32()), signed[0], pa.array(b, pa.int64()), signed[1]], names=["view", "fp", "near", "root"])

    def run(batches):
        held = None
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("view", "code", "value", "fp", "n")]
            rows = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(rows[0]):
                continue
            tail = int(np.flatnonzero((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1]))[0])
            yield close(*[x[:tail] for x in rows])
            held = [x[tail:] for x in rows]
        if held is not None:
            yield close(*held)

    return run


def _crowded(classes: DataFrame, rows: DataFrame, radius: int) -> DataFrame | None:
    """(view, code, value) of the pairs' shards with more than MAX_TREE words, or None.

    A pair's shard is within each of its blocks' words, and block values are few, so counts by block come
    first, map-side; only rows of crowded blocks are counted by pair.
    """
    masks = [_signed(m) for m in _split(list(range(64)), radius + 2)]
    fp = F.col("fp")
    blocks = classes.select("view", F.explode(F.array(*[F.struct(F.lit(k).alias("block"), fp.bitwiseAND(F.lit(m)).alias("part")) for k, m in enumerate(masks)])).alias("at"))
    full = stage(blocks.groupBy("view", "at.block", "at.part").count().where(F.col("count") > MAX_TREE).drop("count"), "blocks")
    if full.isEmpty():
        return None
    first = [a for a, _ in combinations(range(radius + 2), 2)]
    block = F.element_at(F.array(*map(F.lit, first)), (F.col("code") + 1).cast("int"))
    part = fp.bitwiseAND(F.element_at(F.array(*map(F.lit, masks)), block + 1))
    near = rows.withColumns({"block": block, "part": part}).join(full, ["view", "block", "part"], "left_semi")
    return _counted(near)


def _counted(rows: DataFrame) -> DataFrame | None:
    hot = stage(rows.groupBy("view", "code", "value").count().where(F.col("count") > MAX_TREE).drop("count"), "crowded")
    return None if hot.isEmpty() else hot


def link_fingerprints(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links between distinct fingerprints: ``classes`` (fp, n; view, if there are several) -> (view, fp, near, root).

    ``sum(near)`` over an fp's rows counts the rows of other fingerprints of its view within ``radius``
    bits; ``root`` is another member of its component or itself. Sharding is exact: words within r bits
    agree on two of r + 2 blocks, so a shard for each pair of blocks holds every link. A shard of over
    MAX_TREE words is divided by r + 1 parts of its other bits, of which one must agree as well, and
    again while it is still crowded; a shard with FREE_BITS bits left can't be, so no tree grows with
    the input. No pair is emitted: each shard gives at most a row a word.
    """
    if "view" not in classes.columns:
        classes = classes.withColumn("view", F.lit(0))
    pairs = [_signed(m) for m in pairs_of_blocks(radius)]
    rows = classes.select("view", "fp", "n", F.explode(F.array(*[F.lit(c).cast("long") for c in range(len(pairs))])).alias("code"))
    # made from the code on either side of the exchange, so that it needn't travel
    value = F.col("fp").bitwiseAND(F.element_at(F.array(*map(F.lit, pairs)), (F.col("code") + 1).cast("int")))
    shard = ["view", "code", "value"]

    def searched(rows: DataFrame, value: Column) -> DataFrame:
        placed = rows.repartition("view", "code", value).withColumn("value", value).sortWithinPartitions(*shard, "fp")
        return placed.mapInArrow(_searcher(radius), "view int, fp long, near long, root long")

    valued = rows.withColumn("value", value)
    hot, free = _crowded(classes, valued, radius), 64 - min(m.bit_count() for m in pairs_of_blocks(radius))
    if hot is None:
        return searched(rows, value)
    found = searched(valued.join(hot, shard, "left_anti").select("view", "code", "value", "fp", "n"), F.col("value"))
    while hot is not None:
        crowd = valued.join(hot, shard, "left_semi").select("view", "code", "fp", "n")
        valued = stage(crowd.mapInArrow(_divider(radius), "view int, code long, value long, fp long, n long"), "divided")
        free -= free // (radius + 1)
        hot = _counted(valued) if free > FREE_BITS else None
        calm = valued if hot is None else valued.join(hot, shard, "left_anti").select(*valued.columns)
        found = found.unionByName(searched(calm, F.col("value")))
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprint, number of linked rows and component of every row of ``df``.

    Returns the id, ``fp`` (signed 64-bit), ``n_near`` (other rows within ``radius`` bits) and
    ``component_id`` (least id reachable). Rows with one fingerprint are one class throughout, so a
    group of copies of any size costs a row. A null or empty text has fingerprint 0 and links like
    any other; repeated rows count each; a null id stays a row and is least only where all are null.
    An empty table gives an empty one.
    """
    def prints(data):
        return pa.array([fingerprint(x.as_py()) for x in data], pa.int64())

    prints.__annotations__ = {"data": pa.Array, "return": pa.Array}
    fp = F.arrow_udf(prints, "long").asNondeterministic()(ascii_bytes(F.col(text_col)))
    docs = stage(df.select(F.col(id_col).alias("id"), fp.alias("fp")), "simhash")
    classes = stage(docs.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")), "classes")
    links = stage(link_fingerprints(classes.select("fp", "n"), radius), "links")
    near = links.groupBy("fp").agg(F.sum("near").alias("near"))
    roots = connected_components(links.where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b")))
    placed = classes.join(near, "fp", "left").join(roots.withColumnRenamed("a", "fp"), "fp", "left")
    placed = placed.select("fp", "n", "least", F.coalesce("near", F.lit(0)).alias("near"), F.coalesce("root", "fp").alias("root"))
    linked = placed.where("near > 0 OR n > 1")
    component = linked.groupBy("root").agg(F.min("least").alias("component"))
    resolved = linked.join(component, "root").select("fp", (F.col("n") - 1 + F.col("near")).alias("n_near"), "component")
    return docs.join(resolved, "fp", "left").select(
        F.col("id").alias(id_col), "fp", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("component", "id").alias("component_id")
    )


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def copies_by_views(df: DataFrame, id_col: str, text_col: str, views: int, radius: int) -> DataFrame:
    """(id, component_id) of every row: rows link if in any view their word fingerprints are within ``radius`` bits.

    Several fingerprints of hashes of their own find what one misses: where one is within 3 bits of a
    copy's in a third of all cases, the nearest of eight is in nearly all. A row's views
    are one class, so copies cost a row; links and classes meet in one search for components.
    """
    if not 1 <= views <= len(_VIEWS):
        raise ValueError(f"from 1 to {len(_VIEWS)} views, not {views}")

    def prints(data):
        return pa.array([word_fingerprints(x.as_py(), views) for x in data], pa.list_(pa.int64()))

    prints.__annotations__ = {"data": pa.Array, "return": pa.Array}
    fps = F.arrow_udf(prints, "array<long>").asNondeterministic()(ascii_bytes(F.col(text_col)))
    docs = stage(df.select(F.col(id_col).alias("id"), fps.alias("fps")), "views")
    classes = docs.groupBy("fps").agg(F.min("id").alias("least")).withColumn("class", F.monotonically_increasing_id())
    classes = stage(classes, "classes")
    seen = classes.select("class", F.posexplode("fps").alias("view", "fp"))
    # a fingerprint's node is the least class that has it
    nodes = stage(seen.groupBy("view", "fp").agg(F.min("class").alias("node")), "nodes")
    links = stage(link_fingerprints(nodes.select("view", "fp", F.lit(1).cast("long").alias("n")), radius), "links").where("fp <> root")
    ends = nodes.select("view", F.col("fp").alias("root"), F.col("node").alias("b"))
    between = links.join(nodes, ["view", "fp"]).join(ends, ["view", "root"]).select(F.col("node").alias("a"), "b")
    within = seen.join(nodes, ["view", "fp"]).where(F.col("class") != F.col("node")).select(F.col("class").alias("a"), F.col("node").alias("b"))
    roots = connected_components(between.unionByName(within))
    placed = classes.join(roots.withColumnRenamed("a", "class"), "class", "left").select("fps", "least", F.coalesce("root", "class").alias("root"))
    component = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    resolved = placed.join(component, "root").select("fps", "component_id")
    return docs.join(resolved, "fps").select("id", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, views: int = 0) -> DataFrame:
    """``df`` with one row of each component: the least id, of several such rows one alone.

    Components are those of ``near_duplicates`` within ``radius`` or, with ``views``, those by so many
    fingerprints of the distinct words. Columns stay as they are. A null or empty text has fingerprint 0,
    so all such rows are one group. A row with a null id is kept only where its whole group has none;
    repeated rows are copies of each other; an empty table stays empty.
    """
    order = "__mr_row"
    held = stage(df.withColumn(order, F.monotonically_increasing_id()), "rows")
    keyed = held.select(F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.col(order).alias("row")).alias("key"), F.col(text_col).alias("text"))
    if views:
        dropped = copies_by_views(keyed, "key", "text", views, radius).where("id <> component_id").select(F.col("id.row").alias(order))
    else:
        dropped = near_duplicates(keyed, "key", "text", radius).where("key <> component_id").select(F.col("key.row").alias(order))
    return drop_names(held.join(dropped, order, "left_anti"), [order]).select(*df.columns)
