"""Histogram sort: exact splitters of a keyed table by counting below candidate boundaries."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop_names, stage

LOW, HIGH = -(1 << 63), 1 << 63
KEYS = ("__mr_k0", "__mr_k1", "__mr_k2")
WEIGHT = "__mr_w"


@dataclass(frozen=True)
class Splitters:
    """``parts - 1`` boundaries of three-part keys; a key equal to a boundary lies above it.

    ``weights`` and ``rows`` hold what lies below the start of each part, exactly.
    """

    keys: tuple[tuple[int, int, int], ...]
    weights: tuple[int, ...]
    rows: tuple[int, ...]
    total_weight: int
    total_rows: int


def place(keys, k0: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """How many of the sorted boundaries are at most each key."""
    first = np.array([k[0] for k in keys], np.int64)
    at = np.searchsorted(first, k0, "left")
    for value in np.intersect1d(first, k0):
        tied = np.flatnonzero(k0 == value)
        for _, b, c in keys[int(np.searchsorted(first, value, "left")) : int(np.searchsorted(first, value, "right"))]:
            at[tied] += (k1[tied] > b) | ((k1[tied] == b) & (k2[tied] >= c))
    return at


def keyed(df: DataFrame, key: str, weight: Column, tie: Column) -> DataFrame:
    """``df`` with sort keys and weight, staged: passes over it see the same rows under the same keys.

    Order is by ``key`` (integral; null first), ``tie`` (a hash of the content) and place of arrival.
    """
    return stage(
        drop_names(df, (*KEYS, WEIGHT)).select(
            "*", F.coalesce(F.col(key).cast("long"), F.lit(LOW)).alias(KEYS[0]), tie.cast("long").alias(KEYS[1]),
            F.monotonically_increasing_id().alias(KEYS[2]), F.coalesce(weight.cast("long"), F.lit(0)).alias(WEIGHT),
        ),
        "keyed",
    )


def _count(table: DataFrame, probes: dict[tuple[int, ...], list[int]]) -> dict[tuple[int, ...], tuple[list[int], list[int]]]:
    """Weights and rows in each gap between the probes, for rows whose first keys equal the prefix."""
    groups = [(prefix, np.array(at, np.int64)) for prefix, at in probes.items()]

    def gaps(batches):
        sums = [(np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)) for _, at in groups]
        for batch in batches:
            *keys, w = [batch.column(k).to_numpy(zero_copy_only=False) for k in (*KEYS, WEIGHT)]
            for (prefix, at), (weights, rows) in zip(groups, sums):
                own, ww = keys[len(prefix)], w
                if prefix:
                    mask = np.logical_and.reduce([k == p for k, p in zip(keys, prefix)])
                    own, ww = own[mask], w[mask]
                gap = np.searchsorted(at, own, "right")
                np.add.at(weights, gap, ww)
                rows += np.bincount(gap, minlength=len(rows))
        out = [(g, i, int(w), int(r)) for g, (weights, rows) in enumerate(sums) for i, (w, r) in enumerate(zip(weights, rows)) if r]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], [], []))], names=["g", "i", "w", "r"])

    sums = {prefix: ([0] * (len(at) + 1), [0] * (len(at) + 1)) for prefix, at in groups}
    counted = table.select(*KEYS, WEIGHT).mapInArrow(gaps, "g long, i long, w long, r long").groupBy("g", "i").agg(F.sum("w").alias("w"), F.sum("r").alias("r"))
    found = counted.toArrow()  # at most a row for each probe
    for g, i, w, r in zip(*[found[c].to_pylist() for c in ("g", "i", "w", "r")]):
        sums[groups[g][0]][0][i], sums[groups[g][0]][1][i] = w, r
    return sums


def find_splitters(table: DataFrame, parts: int, tolerance: float = 0.001, probes: int = 4096) -> Splitters:
    """Boundaries that cut a ``keyed`` table into ``parts`` of equal weight.

    Every round counts, over all rows, what lies below up to ``probes`` candidates (at least four an
    open boundary), then narrows each boundary's interval to the gap that holds its target. A boundary
    is settled within ``tolerance`` of a part's weight, or at the nearer edge of the one row that
    crosses the target. A key value that crosses it with more than one row is cut by the next part of
    the key, so no value, however common, is left whole. Only counts come to the driver.
    """
    low, high, rows, weight = table.agg(F.min(KEYS[0]), F.max(KEYS[0]), F.count(F.lit(1)), F.coalesce(F.sum(WEIGHT), F.lit(0))).first()
    if not rows or parts < 2:
        return Splitters(((HIGH - 1,) * 3,) * (parts - 1), (0,) + (weight,) * (parts - 1), (0,) + (rows,) * (parts - 1), weight, rows)
    slack = tolerance * weight / parts
    done: dict[int, tuple[tuple[int, ...], int, int]] = {}
    # boundary -> prefix, (weight, rows) below all of its rows, (low, weight below, rows below), the same at the high end
    open_ = {j: ((), (0, 0), (low, 0, 0), (high + 1, weight, rows)) for j in range(1, parts)}
    while open_:
        wanted: dict[tuple[int, ...], set[int]] = {}
        each = max(4, probes // len(open_))
        for prefix, _, (lo, *_), (hi, *_) in set(open_.values()):
            n = min(each, hi - lo - 1)
            wanted.setdefault(prefix, set()).update(lo + (hi - lo) * (k + 1) // (n + 1) for k in range(n))
        places = {prefix: sorted(x) for prefix, x in wanted.items()}
        gaps = _count(table, places)
        below = {}
        for prefix, (w, r), *_ in open_.values():
            if prefix not in below:
                below[prefix] = [list(accumulate(g[:-1], initial=b))[1:] for g, b in zip(gaps[prefix], (w, r))]
        for j, (prefix, base, lo, hi) in list(open_.items()):
            goal = j * weight / parts
            at, (below_w, below_r) = places[prefix], below[prefix]
            k = bisect_right(below_w, goal) - 1
            if k >= 0 and at[k] > lo[0]:
                lo = (at[k], below_w[k], below_r[k])
            k = bisect_left(below_w, goal)
            if k < len(at) and at[k] < hi[0]:
                hi = (at[k], below_w[k], below_r[k])
            near = min(lo, hi, key=lambda x: abs(x[1] - goal))
            single = hi[0] - lo[0] <= 1
            if abs(near[1] - goal) <= slack or hi[2] - lo[2] <= 1 or single and len(prefix) == 2:
                done[j] = ((*prefix, near[0]), near[1], near[2])
                del open_[j]
            elif single:
                open_[j] = ((*prefix, lo[0]), lo[1:], (LOW, *lo[1:]), (HIGH, *hi[1:]))
            else:
                open_[j] = (prefix, base, lo, hi)
    ends = [done[j] for j in range(1, parts)]
    return Splitters(tuple(_full(key) for key, *_ in ends), (0, *(w for _, w, _ in ends)), (0, *(r for *_, r in ends)), weight, rows)


def _full(key: tuple[int, ...]) -> tuple[int, int, int]:
    """A boundary on the first parts of the key as one on all three; the end of a range is the next value before it."""
    while len(key) > 1 and key[-1] >= HIGH:
        key = (*key[:-2], key[-2] + 1)
    if key[0] >= HIGH:
        return (HIGH - 1,) * 3
    return (*key, LOW, LOW)[:3]
