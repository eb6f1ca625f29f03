"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_bytes, drop_names

WORD_BITS = 15
N_WORDS = 1 << WORD_BITS
#: Statistics, each one-hot in BINS bins after the words.
STATS = ("log_words", "log_bytes", "symbols", "upper", "digits", "stops", "word_length", "distinct", "commonest", "dup_lines", "line_words", "non_ascii", "one_char", "exclaims")
BINS = 12
SIZE = N_WORDS + len(STATS) * BINS
#: Labelled rows used for fitting, at most.
MAX_TRAIN = 12_000
_REMEMBERED = 400_000
_memo: dict[bytes, int] = {}
_UPPER, _DIGITS, _SYMBOLS = bytes(range(65, 91)), b"0123456789", b"#*$%&|<>"


def _bin(x: float, low: float, high: float) -> int:
    return min(BINS - 1, max(0, int((x - low) / (high - low) * BINS)))


def features(data: bytes) -> np.ndarray:
    """A text's feature numbers: its distinct words' buckets, then one bin of every statistic."""
    words = data.split()
    n, size = len(words), len(data)
    counts = Counter(words)
    out = []
    for w in counts:
        b = _memo.get(w)
        if b is None:
            if len(_memo) > _REMEMBERED:
                _memo.clear()
            b = _memo[w] = zlib.crc32(w.lower()) % N_WORDS
        out.append(b)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k, m, s = max(n, 1), max(size, 1), max(len(lines), 1)

    def share(chars: bytes) -> int:
        return size - len(data.translate(None, chars))

    stats = (
        _bin(math.log2(n + 1), 0, 16), _bin(math.log2(size + 1), 0, 20), _bin(share(_SYMBOLS) / k, 0, 1.2), _bin(share(_UPPER) / m, 0, 0.6),
        _bin(share(_DIGITS) / m, 0, 0.2), _bin(share(b".,;:?") / k, 0, 0.5), _bin((size - n) / k, 2, 14), _bin(len(counts) / k, 0, 1.0001),
        _bin(max(counts.values(), default=0) / k, 0, 0.5), _bin((len(lines) - len(set(lines))) / s, 0, 0.8), _bin(math.log2(k / s), 0, 8),
        _bin((size - len(data.decode("utf-8", "replace"))) / m, 0, 0.2), _bin(sum(c for w, c in counts.items() if len(w) == 1) / k, 0, 0.6),
        _bin(share(b"!") / k, 0, 1.2),
    )
    return np.array(out + [N_WORDS + i * BINS + b for i, b in enumerate(stats)], np.int32)


def values(lengths: np.ndarray) -> np.ndarray:
    """The features' values: words share a length of 1, statistics one of 1.5."""
    ns = len(STATS)
    words = 1 / np.sqrt(np.maximum(lengths - ns, 1))
    v = np.repeat(words, lengths)
    ends = np.cumsum(lengths)
    v[(ends[:, None] - np.arange(1, ns + 1)).ravel()] = 1.5 / math.sqrt(ns)
    return v.astype(np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, index: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins of rows of features that begin at ``starts`` (none empty), the factor terms and their sums.

        Pairwise terms cost no more than linear ones: sum over i<j of <v_i, v_j> x_i x_j is half of
        (sum of v_i x_i)^2 less the sum of (v_i x_i)^2, factor by factor.
        """
        vx = self.factors[index] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[index] * x, starts) + pairs, vx, sums

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        if not rows:
            return np.empty(0)
        lengths = np.array([len(r) for r in rows])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        z = self.margins(np.concatenate(rows), values(lengths), starts)[0].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, rank: int = 8, epochs: int = 8, batch: int = 128, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, both classes weighing the same, by AdaGrad in a fixed order of batches.

    No rows or one class give a constant.
    """
    rng = np.random.default_rng(seed)
    m = FactorisationMachine(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.02, (SIZE, rank)).astype(np.float32))
    share = float(np.clip((labels.sum() + 1) / (len(labels) + 2), 0.01, 0.99))
    m.bias = math.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        m.factors[:] = 0
        return m
    m.bias = 0.0
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    lengths = np.array([len(r) for r in rows])
    g_b, g_w, g_v = 1e-6, np.full(SIZE, 1e-6, np.float32), np.full((SIZE, rank), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            n = lengths[own]
            starts = np.concatenate(([0], np.cumsum(n)[:-1]))
            index, x = np.concatenate([rows[i] for i in own]), values(n)
            z, vx, sums = m.margins(index, x, starts)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]) * weight[own] / len(own)
            each = np.repeat(g, n).astype(np.float32) * x
            used, at = np.unique(index, return_inverse=True)
            dw = np.bincount(at, each, len(used)) + decay * m.linear[used]
            steps = each[:, None] * (np.repeat(sums, n, axis=0) - vx)
            dv = np.stack([np.bincount(at, steps[:, f], len(used)) for f in range(rank)], axis=1) + decay * m.factors[used]
            g_b += g.sum() ** 2
            g_w[used] += dw**2
            g_v[used] += dv**2
            m.bias -= rate * g.sum() / math.sqrt(g_b)
            m.linear[used] -= rate * dw / np.sqrt(g_w[used])
            m.factors[used] -= rate * 0.3 * dv / np.sqrt(g_v[used])
    return m


def _features_column(text: Column) -> Column:
    def run(data: pa.Array) -> pa.Array:
        return pa.array([features(t).tobytes() for t in data.to_pylist()], pa.binary())

    run.__annotations__ = {"data": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "binary").asNondeterministic()(ascii_bytes(text))


def fold(id_column: Column) -> Column:
    """Which of five folds a row is in: the CRC-32 of its id as text; fold 0 is held out."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> FactorisationMachine:
    """Fit on at most ``max_train`` labelled rows outside fold 0, those with the least hash of their id.

    Of an id's labels the largest counts. The ids (bounded by ``max_train``) are broadcast to the scan of ``docs``;
    what comes to the driver is these rows' features.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 0))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id").select("id", "y", _features_column(F.col("t")).alias("f"))
    # a labelled id may be on any number of documents: one of them, still of bounded number
    rows = rows.groupBy("id", "y").agg(F.min("f").alias("f")).orderBy(F.xxhash64("id"), "id").toArrow()
    return fit([np.frombuffer(f, np.int32) for f in rows["f"].to_pylist()], np.array(rows["y"].to_pylist(), np.float32))


def score_quality(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out (fold 0), score (0 to 1) and predicted (score at least ``threshold``), replacing such columns.

    A score depends on the text alone, so repeated rows and equal texts score alike; a null or empty
    text is scored by its statistics. The model has a fixed size and travels with the task.
    """
    bias, linear, factors = model.bias, model.linear, model.factors

    def run(data: pa.Array) -> pa.Array:
        m = FactorisationMachine(bias, linear, factors)
        out = [m.scores([features(t) for t in data.slice(k, 256).to_pylist()]) for k in range(0, len(data), 256)]
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    run.__annotations__ = {"data": pa.Array, "return": pa.Array}
    rows = drop_names(docs.withColumn("__mr_score", F.arrow_udf(run, "double").asNondeterministic()(ascii_bytes(F.col(text_col)))), ("held_out", "score", "predicted"))
    own = [F.col(f"`{c}`") for c in rows.columns if c != "__mr_score"]
    score = F.col("__mr_score")
    return rows.select(*own, (fold(F.col(id_col)) == 0).alias("held_out"), score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted"))
