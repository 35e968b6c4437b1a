"""Toxicity by compression distance (operator 3).

Two zstandard dictionaries are built from labelled texts: one of windows that
mark toxic texts, one of windows usual in ordinary texts.  A window is a word
of the text, tiled so that its compressed length is the cost of its first
occurrence.  Its gain is the length with the ordinary dictionary less the
length with the toxic one.  A text's score follows from how many of its
distinct windows gain at least a threshold.

The dictionaries hold raw content (windows in order of evidence).  How many
toxic windows they hold, the threshold and the probability for each count of
hits are calibrated on a part of the labelled rows that built no dictionary.

Training reads at most about ``max_train_rows`` labelled rows of each class,
chosen by a hash of the id; copies of a text with the same label, equal or
nearly so, teach once.  Scoring covers every row and whole texts.  Null and empty texts have no window and get the score of no
hits.  Without labelled rows of both classes every score is the share of toxic
ones (0 without any).  An empty table gives no rows.  Only ``doc_id`` and
``text`` of the documents are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import arrow_map, cut, fold, keyed
from framelake.llm.quality import isotonic
from framelake.llm.text_hash import ALNUM, mix, slices, windows, words

MAX_TRAIN_ROWS = 10_000       # of each class
ORDINARY_WINDOWS = 12_000     # at most, most frequent first
TOXIC_WINDOWS = 2048          # at most, strongest evidence first
MIN_ROWS = 3                  # texts that a toxic window must be in
MIN_LIFT = 4.0                # how much likelier a window is in toxic texts
TILES = 5
THRESHOLD = 0.3
MAX_HITS = 4                  # hits from here on count alike
CACHE = 400_000               # windows remembered by a task


def tile(window: bytes) -> bytes:
    return (b" " + window) * TILES + b" "


def compressor(content_windows: list[bytes]) -> zstd.ZstdCompressor:
    """A compressor whose dictionary has the first windows nearest to its end,
    where references are cheapest."""
    content = b" ".join([b"", *content_windows[::-1]]) + b" " * 16
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    # a full search for matches of three bytes and more, so that a length
    # tells what a dictionary holds and not how well it was searched
    params = zstd.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=3, target_length=64,
                                            strategy=zstd.STRATEGY_BTLAZY2, write_checksum=0, write_content_size=0, write_dict_id=0,
                                            format=zstd.FORMAT_ZSTD1_MAGICLESS)
    d.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=d, compression_params=params)


@dataclass
class Gains:
    """Gain of a window, remembered while it is likely to come again."""

    toxic: list[bytes]
    ordinary: list[bytes]
    known: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary}

    def __setstate__(self, state):
        self.__init__(state["toxic"], state["ordinary"])

    def __call__(self, window: bytes) -> int:
        g = self.known.get(window)
        if g is None:
            if self._pair is None:
                self._pair = compressor(self.ordinary), compressor(self.toxic)
            if len(self.known) >= CACHE:
                self.known.clear()
            t = tile(window)
            g = self.known[window] = len(self._pair[0].compress(t)) - len(self._pair[1].compress(t))
        return g


def text_windows(column: pa.Array):
    """Distinct words (bytes) of each text, in text order."""
    for s in slices(pc.utf8_lower(column.fill_null(""))):
        w = words(s, ALNUM)
        body = s.data.tobytes()
        for t in range(len(s.offsets) - 1):
            a, z = w.first[t], w.first[t + 1]
            _, first = np.unique(w.hash[a:z], return_index=True)
            yield [body[i:j] for i, j in zip(w.start[a:z][first].tolist(), w.end[a:z][first].tolist())]


@dataclass
class Model:
    gains: Gains | None
    threshold: int
    chance: np.ndarray           # probability for 0, 1, .. MAX_HITS hits

    def hits(self, column: pa.Array) -> np.ndarray:
        if self.gains is None:
            return np.zeros(len(column), np.int64)
        return np.array([sum(self.gains(w) >= self.threshold for w in ws) for ws in text_windows(column)], np.int64)

    def score(self, hits: np.ndarray) -> np.ndarray:
        return self.chance[np.minimum(hits, len(self.chance) - 1)]


def labelled(labels: DataFrame, label: str, learn: Column, max_rows: int) -> DataFrame:
    """``doc_id, y`` with at most about ``max_rows`` rows of each class."""
    rows = (labels.where(learn).where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30))
    rate = F.when(F.col("y") == 1, min(1.0, max_rows / max(1, counts.get(1, 0)))).otherwise(min(1.0, max_rows / max(1, counts.get(0, 0))))
    return rows.where(draw < rate * (1 << 30))


def once(rows: DataFrame) -> DataFrame:
    """One row of each group of copies, equal or nearly so: rows of one label
    whose runs of three words have the same least hash under two of three
    seeds.  Texts with a fifth of all their runs in common merge with a chance
    of one in ten, with nine tenths in common nearly always."""
    seeds = (1, 2, 3)

    def make(b: pa.RecordBatch):
        least = np.zeros((len(seeds), b.num_rows), np.int64)
        for s in slices(b.column(0)):
            w = words(s, ALNUM)
            for t in range(len(s.offsets) - 1):
                own = w.hash[w.first[t]:w.first[t + 1]]
                runs = windows(own, 3) if len(own) > 3 else windows(own, len(own)) if len(own) else np.zeros(1, np.uint64)
                for k, seed in enumerate(seeds):
                    least[k, s.first + t] = mix(runs + np.uint64(seed)).min().astype(np.int64)
        return pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x) for x in least]], names=["text", "y", *(f"m{k}" for k in seeds)])
    out = arrow_map(rows, make, "text string, y int, m1 long, m2 long, m3 long").withColumn("h", F.xxhash64("text"))
    for band in combinations([f"m{k}" for k in seeds], 2):
        (other,) = {f"m{k}" for k in seeds} - set(band)
        out = out.groupBy("y", *band).agg(F.min_by(F.struct("text", other, "h"), F.struct("h", "text")).alias("r")).select("y", *band, "r.*")
    return out.select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", max_train_rows: int = MAX_TRAIN_ROWS) -> Model:
    ids = labelled(labels, label, learn, max_train_rows)       # bounded, so it may be broadcast
    rows = once(keyed(docs).join(F.broadcast(ids), "doc_id").select("text", "y"))
    rows = cut(rows.withColumn("build", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(10)) < 6), "toxicity-train")
    n = {(r["build"], r["y"]): r["n"] for r in rows.groupBy("build", "y").agg(F.count("*").alias("n")).collect()}
    total, toxic = sum(n.values()), sum(v for (_, y), v in n.items() if y)
    n1, n0 = n.get((True, 1), 0), n.get((True, 0), 0)
    constant = Model(None, 0, np.full(MAX_HITS + 1, toxic / total if total else 0.0))
    if not n1 or not n0:
        return constant

    def make(b: pa.RecordBatch):
        for y, ws in zip(b.column(1).to_pylist(), text_windows(b.column(0))):
            yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array([y] * len(ws), pa.int32())], names=["w", "y"])
    counts = arrow_map(rows.where("build").select("text", "y"), make, "w binary, y int").groupBy("w").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    p, q = (F.col("a") + 0.5) / (n1 + 1), (F.col("b") + 0.5) / (n0 + 1)
    counts = cut(counts.withColumn("lift", p / q).withColumn("proof", F.col("a") * F.log(p / q)), "toxicity-windows")
    marks = [bytes(r["w"]) for r in counts.where((F.col("a") >= MIN_ROWS) & (F.col("lift") >= MIN_LIFT))
             .orderBy(F.desc("proof"), "w").limit(TOXIC_WINDOWS).collect()]
    usual = [bytes(r["w"]) for r in counts.where((F.col("b") >= 2) & (F.col("lift") < 2.0))
             .orderBy(F.desc("b"), "w").limit(ORDINARY_WINDOWS).collect()]
    if not marks:
        return constant
    sizes = sorted({min(len(marks), 1 << k) for k in range(2, 12)} | {min(len(marks), 3 << k) for k in range(1, 10)})
    trial = [Gains(marks[:m], usual) for m in sizes]
    cuts = list(range(1, 9))

    def tried(b: pa.RecordBatch):
        y = b.column(1).to_pylist()
        out = [[], [], [], []]
        for t, ws in zip(y, text_windows(b.column(0))):
            for k, g in enumerate(trial):
                gains = [x for x in map(g, ws) if x > 0]
                for c in cuts:
                    for col, v in zip(out, (k, c, min(MAX_HITS, sum(x >= c for x in gains)), t)):
                        col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in out], names=["k", "c", "hits", "y"])
    table = arrow_map(rows.where(~F.col("build")).select("text", "y"), tried, "k int, c int, hits int, y int").groupBy("k", "c", "hits").agg(
        F.sum("y").alias("a"), F.count("*").alias("n")).toPandas()       # at most sizes x cuts x counts of hits
    # class sizes of the sample are brought back to those of all labelled rows
    seen = labels.where(learn).where(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    prior = min(max(seen or 0.0, 1e-6), 1 - 1e-6)
    held1, held0 = max(n.get((False, 1), 0), 1), max(n.get((False, 0), 0), 1)
    best, model = None, constant
    for (k, c), g in table.groupby(["k", "c"]):
        a, b = np.zeros(MAX_HITS + 1), np.zeros(MAX_HITS + 1)
        a[g["hits"].to_numpy()] = g["a"].to_numpy()
        b[g["hits"].to_numpy()] = (g["n"] - g["a"]).to_numpy()
        w1, w0 = prior * (a + 0.25) / held1, (1 - prior) * (b + 0.25) / held0
        chance = w1 / (w1 + w0)
        loss = -float((prior * a / held1 * np.log(chance) + (1 - prior) * b / held0 * np.log(1 - chance)).sum())
        if best is None or loss < best - 1e-9:
            best = loss
            knots, values = isotonic(np.arange(MAX_HITS + 1.0), chance, w1 + w0)
            model = Model(trial[int(k)], int(c), np.interp(np.arange(MAX_HITS + 1.0), knots, values))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_hits and score of every row."""
    def make(b: pa.RecordBatch):
        hits = model.hits(b.column(1))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(hits), pa.array(model.score(hits))], names=["doc_id", "n_hits", "score"])
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, "doc_id long, n_hits long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, fold("doc_id", 4) != 2)
    return score(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits")
