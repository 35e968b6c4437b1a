"""The whole fingerprint query against a plain computation of every column."""

import hashlib
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from framelake.llm import simhash
from tests.llm.conftest import ODD, prose


def fingerprint(text: str) -> tuple[int, int]:
    sums, n = [0] * 128, 0
    for w in text.lower().translate(str.maketrans("\n\t\r\f\v", "     ")).split(" "):
        b = w.encode()
        v = 0 if not b else 1 if len(b) <= 3 else 4
        h0 = xxhash.xxh64_intdigest(b, 42)
        h1 = xxhash.xxh64_intdigest(struct.pack("<i", 1), h0)
        n += v
        for k in range(64):
            sums[k] += v * (h0 >> k & 1)
            sums[64 + k] += v * (h1 >> k & 1)
    half = [sum((2 * s > n) << k for k, s in enumerate(sums[a:a + 64])) for a in (0, 64)]
    return half[0], half[1]


def brute(spark, rows):
    """All columns of every row; ``rows`` have different (id, text hash)."""
    texts = [(k, t or "") for k, t in rows]
    order = {t: h for t, h in spark.createDataFrame([(t,) for _, t in texts], "text string").select("text", F.xxhash64("text")).distinct().collect()}
    texts.sort(key=lambda r: (r[0] is not None, r[0] or 0, order[r[1]]))
    prints = [fingerprint(t) for _, t in texts]
    apart = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b))
    out = []
    for i, (k, t) in enumerate(texts):
        j = (i + 1) % len(texts)
        h = len(t) // 2
        edited = t[:len(t) - h] + texts[j][1][:h]
        e = fingerprint(edited)
        close = [m for m in range(len(texts)) if apart(prints[i], prints[m]) <= simhash.RADIUS]
        ids = [texts[m][0] for m in close if texts[m][0] is not None]
        asked = k is not None and k % simhash.QUERY_EVERY == 0
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), "%016x%016x" % prints[i], "%016x%016x" % e,
                    1 - apart(prints[i], e) / 128, 1 - apart(prints[i], prints[j]) / 128,
                    len(close) - 1 if asked else None, min(ids) if asked else None))
    return out


def test_every_column(spark, make_docs):
    base = prose(3, 400).split()
    rows = [r for r in dict.fromkeys(ODD) if r[0] is None or r[0] not in (6, 7)]
    rows += [(20 * k, prose(k, 60)) for k in range(1, 6)] + [(1000 + k, prose(1 + k % 5, 60)) for k in range(30)]
    # one word of 400 changed: fingerprints a few bits apart
    rows += [(2000 + k, " ".join([*base[:k], "changed", *base[k + 1:]])) for k in range(61)] + [(10 ** 15, prose(9, 30)), (None, "another")]
    got = [tuple(r) for r in simhash.digest(make_docs(rows)).collect()]
    want = brute(spark, rows)
    assert Counter(got) == Counter(want)
    found = [r[7] for r in want if r[7] is not None]
    assert max(found) > 5 and min(found) == 0        # near ones and copies, and rows with none


def test_runs_of_outlying_and_null_ids(spark, make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 32)
    rows = [(k, f"text {k}") for k in range(1000)] + [(10 ** 15, "far"), (-10 ** 15, "far too")] + [(None, f"no id {k}") for k in range(1000)]
    docs = make_docs(rows).select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    runs, n = simhash._runs(docs)
    sizes = [r["count"] for r in runs.groupBy("run").count().collect()]
    assert max(sizes) <= 4 * 32 and runs.agg(F.max("run")).first()[0] < n
    # runs follow the order of the rows
    key = F.struct(F.col("doc_id").isNotNull(), "doc_id", "h")
    spans = runs.groupBy("run").agg(F.min(key).alias("a"), F.max(key).alias("z")).orderBy("run").collect()
    rank = lambda s: (s[0], s[1] or 0, s[2] if not s[0] else 0)
    assert all(rank(x["z"]) < rank(y["a"]) for x, y in zip(spans, spans[1:]))


def test_more_runs_than_one_window_orders(spark, make_docs, monkeypatch):
    # the heads of runs take two coarser steps before the last
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 4)
    monkeypatch.setattr(simhash, "LAST_ROWS", 16)
    rows = [(k, prose(k, 8)) for k in range(120)] + [(None, f"no id {k}") for k in range(30)] + [(7, "again"), (10 ** 15, "far")]
    assert simhash._runs(make_docs(rows).select("doc_id", "text").withColumn("h", F.xxhash64("text")))[1] > 4 * 16
    got = [tuple(r) for r in simhash.digest(make_docs(rows)).collect()]
    assert Counter(got) == Counter(brute(spark, rows))
