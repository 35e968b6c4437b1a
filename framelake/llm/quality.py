"""Quality classifier (operator 1).

Statistics of the whole text (shares of byte classes, word and line shape,
repetition) are standardised and mapped to random Fourier features, which
approximate a Gaussian kernel.  Each task sums its part of the normal
equations per cross-validation fold; Spark adds the parts and the driver
solves one small ridge system per fold.  Isotonic regression on out-of-fold
scores turns the ridge score into a probability.

Training reads at most about ``max_train_rows`` labelled rows, chosen by a
hash of the id; scoring covers every row.  Null and empty texts have
statistics of their own (all zero) and get a score like any other.  Null
labels teach nothing, several labels of one id are averaged, an id that
repeats in the documents teaches once per row.  Without labels every score is
0.5; with labels of one class it is that class.  An empty table gives no rows.
Only ``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import arrow_map, cut, fold, keyed
from framelake.llm.text_hash import NOT_SPACE, slices, windows, words

MAX_TRAIN_ROWS = 200_000
FOURIER = 160            # random features, over two widths
RIDGE = 3.0              # per feature, in units of rows
FOLDS = 4
THRESHOLD = 0.3
SEED = 20_011

_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
            "space": b" \t", "line": b"\n\r", "stop": b".", "comma": b",", "mark": b"!?", "pipe": b"|", "symbol": b"#$%&*@^~+=<>",
            "quote": b"\"'`", "bracket": b"()[]{}/\\_-:;"}
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _k, _v in enumerate(_CLASSES.values()):
    _CLASS[np.frombuffer(_v, np.uint8)] = _k
_CLASS[128:] = len(_CLASSES) + 1
_N_CLASS = len(_CLASSES) + 2
_NOT_LINE = np.ones(256, bool)
_NOT_LINE[[10, 13]] = False
_SYMBOL = np.isin(_CLASS, [list(_CLASSES).index(c) for c in ("mark", "pipe", "symbol", "quote")])
N_STATS = _N_CLASS + 11


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    out = np.zeros((len(column), N_STATS))
    for s in slices(column):
        n = len(s.offsets) - 1
        size = np.diff(s.offsets)
        owner = np.repeat(np.arange(n), size)
        share = np.bincount(owner * _N_CLASS + _CLASS[s.data], minlength=n * _N_CLASS).reshape(n, _N_CLASS)
        some = np.maximum(size, 1)[:, None]
        w, lines = words(s, NOT_SPACE), words(s, _NOT_LINE)
        n_words, n_lines = np.diff(w.first), np.diff(lines.first)
        length = (w.end - w.start).astype(float)
        last, lead = s.data[np.maximum(w.end - 1, 0)] if len(w.end) else np.zeros(0, np.uint8), s.data[w.start]
        triples = windows(w.hash, 3)

        def mean(v, first, count):
            total = np.concatenate(([0.0], np.cumsum(v)))
            return (total[first[1:]] - total[first[:-1]]) / np.maximum(count, 1)
        rows = out[s.first:s.first + n]
        rows[:, :_N_CLASS] = share / some
        k = _N_CLASS
        average = mean(length, w.first, n_words)
        rows[:, k] = np.log1p(size)
        rows[:, k + 1] = np.log1p(n_words)
        rows[:, k + 2] = average
        rows[:, k + 3] = np.sqrt(np.maximum(mean(length ** 2, w.first, n_words) - average ** 2, 0))
        rows[:, k + 4] = mean(_SYMBOL[last].astype(float), w.first, n_words)
        rows[:, k + 5] = mean((_CLASS[lead] == 1).astype(float), w.first, n_words)
        rows[:, k + 6] = np.log1p(n_lines)
        rows[:, k + 7] = np.log1p(mean((lines.end - lines.start).astype(float), lines.first, n_lines))
        for t in range(n):
            a, z = w.first[t], w.first[t + 1]
            if z - a:
                rows[t, k + 8] = len(np.unique(w.hash[a:z])) / (z - a)
            if z - a > 2:
                rows[t, k + 9] = 1 - len(np.unique(triples[a:z - 2])) / (z - a - 2)
            b, y = lines.first[t], lines.first[t + 1]
            if y - b:
                rows[t, k + 10] = 1 - len(np.unique(lines.hash[b:y])) / (y - b)
    return out


@dataclass
class Model:
    """What scoring needs; a few hundred numbers whatever the input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray          # isotonic regression: raw scores ...
    values: np.ndarray         # ... and probabilities
    constant: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Bias, standardised statistics and random Fourier features."""
    z = np.clip((x - mean) / scale, -6, 6)
    rng = np.random.default_rng(SEED)
    omega = rng.normal(size=(N_STATS, FOURIER))
    width = np.where(np.arange(FOURIER) % 2, 1.0, 3.0) * np.sqrt(N_STATS)
    phase = rng.uniform(0, 2 * np.pi, FOURIER)
    return np.hstack([np.ones((len(z), 1)), z, np.sqrt(2.0) * np.cos(z @ (omega / width) + phase)])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted pool-adjacent-violators; ``x`` ascending.  Knots and values."""
    blocks: list[list[float]] = []           # mean of y, weight, mean of x
    for a, b, c in zip(x.tolist(), y.tolist(), w.tolist()):
        blocks.append([b, c, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (y1, w1, x1), (y2, w2, x2) = blocks[-2], blocks.pop()
            blocks[-1] = [(y1 * w1 + y2 * w2) / (w1 + w2), w1 + w2, (x1 * w1 + x2 * w2) / (w1 + w2)]
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


def with_statistics(docs: DataFrame) -> DataFrame:
    def make(b: pa.RecordBatch):
        x = statistics(b.column(1))
        return pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_STATS).cast(pa.list_(pa.float64()))],
                                          names=["doc_id", "x"])
    return arrow_map(keyed(docs), make, T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), N_STATS)


def labelled(labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, y``: rows that may be learnt from, at most about ``max_rows``."""
    rows = (labels.where(learn).where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("y")))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    return rows


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """``stats``: doc_id and x (see with_statistics); ``labels``: doc_id and y."""
    train = cut(stats.join(labels, "doc_id").select("x", "y", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("k")), "quality-train")
    seen = train.agg(F.count("*").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                     *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(N_STATS)],
                     *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(N_STATS)]).first()
    if not seen["n"] or seen["lo"] == seen["hi"]:
        zero = np.zeros(N_STATS)
        return Model(zero, zero + 1, None, zero, zero, 0.5 if not seen["n"] else float(seen["lo"]))
    mean = np.array([seen[f"m{i}"] for i in range(N_STATS)])
    scale = np.array([max(seen[f"s{i}"], 1e-6) for i in range(N_STATS)])
    size = 1 + N_STATS + FOURIER
    upper = np.triu_indices(size)

    def normal(batches):
        sums = np.zeros((FOLDS, size, size + 1))
        for b in batches:
            z = features(_matrix(b.column(0)), mean, scale)
            y, k = b.column(1).to_numpy(), b.column(2).to_numpy()
            for f in range(FOLDS):
                own = k == f
                if own.any():
                    sums[f, :, :size] += z[own].T @ z[own]
                    sums[f, :, size] += z[own].T @ y[own]
        for f in range(FOLDS):
            if sums[f].any():
                flat = np.concatenate([sums[f, :, :size][upper], sums[f, :, size]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), f, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                                                 names=["k", "at", "v"])
    parts = train.mapInArrow(normal, "k int, at int, v double").groupBy("k", "at").agg(F.sum("v").alias("v")).toPandas()
    a, c = np.zeros((FOLDS, size, size)), np.zeros((FOLDS, size))
    for f, g in parts.groupby("k"):
        flat = np.zeros(len(upper[0]) + size)
        flat[g["at"].to_numpy()] = g["v"].to_numpy()
        a[f][upper] = flat[:len(upper[0])]
        a[f] = a[f] + np.triu(a[f], 1).T
        c[f] = flat[len(upper[0]):]
    penalty = RIDGE * np.eye(size)
    penalty[0, 0] = 1e-6
    weights = np.linalg.solve(a.sum(0) + penalty, c.sum(0))
    others = np.stack([np.linalg.solve(a.sum(0) - a[f] + penalty, c.sum(0) - c[f]) for f in range(FOLDS)])

    def out_of_fold(batches):
        for b in batches:
            k = b.column(2).to_numpy()
            raw = np.einsum("ij,ij->i", features(_matrix(b.column(0)), mean, scale), others[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.round(raw, 3), -1, 2)), b.column(1)], names=["raw", "y"])
    bins = (train.mapInArrow(out_of_fold, "raw double, y double").groupBy("raw")     # at most 3,001 bins
            .agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("raw").toPandas())
    knots, values = isotonic(bins["raw"].to_numpy(), bins["y"].to_numpy(), bins["n"].to_numpy(float))
    return Model(mean, scale, weights, knots, values)


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    at = stats.columns.index("x")

    def make(b: pa.RecordBatch):
        return pa.RecordBatch.from_arrays([*b.columns[:at], *b.columns[at + 1:], pa.array(model.score(_matrix(b.column(at))))],
                                          names=[*(c for c in b.schema.names if c != "x"), "score"])
    fields = [f for f in stats.schema.fields if f.name != "x"]
    return arrow_map(stats, make, T.StructType([*fields, T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model accepts, unchanged."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("text"))

    def make(b: pa.RecordBatch):
        good = model.score(statistics(b.column(1))) >= threshold
        return b.select(["_row"]).filter(pa.array(good))
    return arrow_map(packed, make, T.StructType([packed.schema["_row"]])).select("_row.*")


def learn_rows(parts: int, held: int) -> Column:
    return fold("doc_id", parts) != held


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = cut(with_statistics(docs), "quality-statistics")
    model = fit(stats, labelled(labels, "quality", learn_rows(5, 0)))
    got = score_statistics(stats, model)
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
