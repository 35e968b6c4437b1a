"""Language identification (operator 2).

A text becomes a TF-IDF vector of hashed byte trigrams of its lower-cased
letters.  Each language gets several centroids: Lloyd's iterations on the
sphere over at most about ``sample_per_language`` training texts a language,
with sums made by Spark.  A text takes the language of the centroid with the
largest cosine; texts farther from it than nearly all training texts are
marked as rejected.  Document frequencies count every training text.

Null, empty and letterless texts are ``und`` with score 0.  Rows without a
language or id teach nothing.  Without training rows every text is ``und``.
Ties between centroids go to the language that sorts first.  Repeated rows
count each.  Only ``doc_id``, ``text`` and (to learn) ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import arrow_map, arrow_rows, cut, fold
from framelake.llm.text_hash import slices

DIM = 1 << 13
CLUSTERS = 4
ROUNDS = 4
SAMPLE_PER_LANGUAGE = 2000
REJECT_QUANTILE = 0.002
GROUP = 128                 # texts in one dense block
UNDEFINED = "und"

_LETTER = np.full(256, 32, np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of texts as counts of hashed trigrams: first row, matrix."""
    for s in slices(pc.utf8_lower(column.fill_null(""))):
        d = _LETTER[s.data]
        n = len(s.offsets) - 1
        code = np.zeros(len(d), np.int64)
        if len(d) > 2:
            g = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
            code[:-2] = ((g * np.uint32(0x9E3779B1)) >> np.uint32(19)).astype(np.int64)
            blank = (d[:-2] == 32) & (d[1:-1] == 32)
            code[:-2][blank] = -1
        code[-2:] = -1
        ends = s.offsets[1:]
        for back in (1, 2):                     # trigrams must not cross texts
            at = ends - back
            code[at[at >= s.offsets[:-1]]] = -1
        for lo in range(0, n, GROUP):
            hi = min(lo + GROUP, n)
            part = code[s.offsets[lo]:s.offsets[hi]]
            owner = np.repeat(np.arange(hi - lo), np.diff(s.offsets[lo:hi + 1]))
            ok = part >= 0
            m = np.bincount(owner[ok] * DIM + part[ok], minlength=(hi - lo) * DIM).reshape(hi - lo, DIM)
            yield s.first + lo, m


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray        # rows of length one
    owner: list[str]             # language of each centroid
    floor: np.ndarray            # smallest accepted cosine of each centroid

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(column)
        lang, score, rejected = [UNDEFINED] * n, np.zeros(n), np.ones(n, bool)
        letters = pc.match_substring_regex(column.fill_null(""), r"\pL").to_numpy(zero_copy_only=False)
        if not self.owner:
            return lang, score, rejected
        for first, counts in grams(column):
            cos = tfidf(counts, self.idf) @ self.centroids.T
            best = cos.argmax(1)
            for t, c in enumerate(best.tolist()):
                if letters[first + t]:
                    lang[first + t], score[first + t] = self.owner[c], min(1.0, max(0.0, float(cos[t, c])))
                    rejected[first + t] = cos[t, c] < self.floor[c]
        return lang, score, rejected


def fit(docs: DataFrame, learn: Column, sample_per_language: int = SAMPLE_PER_LANGUAGE,
        clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Model:
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}   # one row a language
    if not counts:
        return Model(np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), [], np.zeros(0))
    langs = sorted(counts)

    def frequencies(batches):
        total = np.zeros(DIM, np.int64)
        for b in batches:
            for _, m in grams(b.column(0)):
                total += (m > 0).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "df"])
    df = np.zeros(DIM)
    for r in arrow_rows(rows.select("text"), frequencies, "slot int, df long").groupBy("slot").agg(F.sum("df").alias("df")).collect():
        df[r["slot"]] = r["df"]
    idf = (np.log((1 + sum(counts.values())) / (1 + df)) + 1).astype(np.float32)

    # a sample by hash, of a rate of its own for each language
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1 << 30, int((1 << 30) * sample_per_language / n)))])
    sample = rows.where(draw < rate[F.col("lang")]).select("text", "lang", F.xxhash64("doc_id", F.lit(8)).alias("h"))

    def vectors(b: pa.RecordBatch):
        for first, m in grams(b.column(0)):
            v = tfidf(m, idf)
            at = [np.flatnonzero(r) for r in m]
            yield pa.RecordBatch.from_arrays(
                [b.column(1).slice(first, len(m)), b.column(2).slice(first, len(m)), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                 pa.array([r[a] for r, a in zip(v, at)], pa.list_(pa.float32()))], names=["lang", "h", "at", "v"])
    points = cut(arrow_map(sample, vectors, "lang string, h long, at array<int>, v array<float>").where(F.size("at") > 0), "language-sample")

    # start: the ``clusters`` sampled texts of each language that hash lowest
    start = points.groupBy("lang").agg(F.min_by(F.struct("at", "v"), "h").alias("p0"),
                                       *[F.min_by(F.struct("at", "v"), F.xxhash64("h", F.lit(i))).alias(f"p{i}") for i in range(1, clusters)]).collect()
    centers = {r["lang"]: [dense(r[f"p{i}"]["at"], r[f"p{i}"]["v"]) for i in range(clusters)] for r in start}
    for _ in range(rounds):
        c = {lang: np.stack(v) for lang, v in centers.items()}
        sums = arrow_rows(points.select("lang", "at", "v"), lambda batches, c=c: assign(batches, c), "lang string, c int, slot int, v double")
        got = sums.groupBy("lang", "c", "slot").agg(F.sum("v").alias("v")).toPandas()       # languages x clusters x slots at most
        centers = {}
        for (lang, _c), g in got.groupby(["lang", "c"]):
            x = np.zeros(DIM)
            x[g["slot"].to_numpy()] = g["v"].to_numpy()
            centers.setdefault(lang, []).append((x / np.sqrt((x * x).sum())).astype(np.float32))
    owner = [lang for lang in langs for _ in centers.get(lang, ())]
    stacked = np.stack([x for lang in langs for x in centers.get(lang, ())]) if owner else np.zeros((0, DIM), np.float32)

    def distances(batches):
        for b in batches:
            cos = [np.asarray(v) @ stacked[:, np.asarray(a)].T for a, v in zip(b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))]
            best = [int(x.argmax()) for x in cos]
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.int32()), pa.array([float(x.max()) for x in cos])], names=["c", "cos"])
    floor = np.zeros(len(owner))
    for r in arrow_rows(points.select("lang", "at", "v"), distances, "c int, cos double").groupBy("c").agg(
            F.percentile_approx("cos", REJECT_QUANTILE).alias("q")).collect():
        floor[r["c"]] = r["q"]
    return Model(idf, stacked, owner, floor)


def dense(at, v) -> np.ndarray:
    x = np.zeros(DIM, np.float32)
    x[list(at)] = v
    return x


def assign(batches, centers: dict[str, np.ndarray]):
    """Per task: sums of the vectors nearest to each centroid of their language."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    for b in batches:
        for lang, at, v in zip(b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)):
            at = np.asarray(at)
            c = int((centers[lang][:, at] @ np.asarray(v)).argmax())
            sums.setdefault((lang, c), np.zeros(DIM))[at] += v
    for (lang, c), x in sums.items():
        at = np.flatnonzero(x)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(np.full(len(at), c, np.int32)), pa.array(at.astype(np.int32)), pa.array(x[at])],
                                         names=["lang", "c", "slot", "v"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (cosine) and rejected of every row."""
    def make(b: pa.RecordBatch):
        lang, score, rejected = model.predict(b.column(1))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                          names=["doc_id", "lang_pred", "score", "rejected"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, make, "doc_id long, lang_pred string, score double, rejected boolean")


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs, fold("doc_id", 3) != 1)
    got = predict(docs, model)
    return got.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
