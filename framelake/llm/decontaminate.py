"""Benchmark decontamination (operator 8).

The windows of all benchmark items (13 normalised words; a shorter item is one
window) form a hash set that every task gets by broadcast.  The set's size is
checked first: beyond ``max_broadcast_windows`` the same rows come from a join
on the windows instead.  Each training text is scanned as one vectorised pass
over Arrow buffers, and each hash hit is verified against the words of the
item before it counts.

Null, empty texts and texts without words have no hit.  Items without words
have no window.  Items with equal ids are one item; every row of a repeated
document is judged by itself.  Empty tables give no hits or no rows.  Only
``doc_id``/``text`` and ``item_id``/``text`` are read, so extra columns never
clash.  A null ``item_id`` is listed as the text ``null``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import arrow_map, cut, keyed
from framelake.llm.text_hash import ALNUM, LOWER, Slice, Words, slices, windows, words

WINDOW = 13
MAX_BROADCAST_WINDOWS = 500_000        # at most about 150 MB in a task
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
         T.StructField("contaminated", T.BooleanType()), T.StructField("items", T.ArrayType(T.StringType())),
         T.StructField("spans", SPANS)]


def _body(s: Slice, w: Words, p: int, size: int) -> bytes:
    """Words p .. p+size-1, lower-cased and joined by blanks."""
    base = w.start[p]
    low = LOWER[s.data[base:w.end[p + size - 1]]]
    return b" ".join(low[w.start[q] - base:w.end[q] - base].tobytes() for q in range(p, p + size))


def benchmark_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct windows of all items: item, length in words, hash, words."""
    def make(b: pa.RecordBatch):
        ids, out = b.column(0).to_pylist(), []
        for s in slices(b.column(1)):
            w = words(s, ALNUM)
            for t in range(len(s.offsets) - 1):
                a, z = int(w.first[t]), int(w.first[t + 1])
                size = min(window, z - a)
                if size:
                    for p, h in enumerate(windows(w.hash[a:z], size).view(np.int64).tolist(), a):
                        out.append((ids[s.first + t], size, h, _body(s, w, p, size)))
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                          names=["item_id", "size", "hash", "words"])
    src = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return arrow_map(src, make, "item_id string, size int, hash long, words binary").distinct()


def _spans(s: Slice, w: Words, t: int, mask: np.ndarray) -> list[dict]:
    """Maximal runs of hit words as code-point spans of the text."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    base = s.offsets[t]
    points = np.concatenate(([0], np.cumsum((s.data[base:s.offsets[t + 1]] & 0xC0) != 0x80)))
    return [{"start": int(points[w.start[w.first[t] + a] - base]), "end": int(points[w.end[w.first[t] + z - 1] - base])}
            for a, z in zip(edge[::2], edge[1::2])]


class _Found:
    """Collects the result columns text by text."""

    def __init__(self):
        self.n_words, self.n_hit, self.items, self.spans = [], [], [], []

    def add(self, s: Slice, w: Words, t: int, mask, items) -> None:
        n, k = int(w.first[t + 1] - w.first[t]), 0 if mask is None else int(mask.sum())
        self.n_words.append(n)
        self.n_hit.append(k)
        self.items.append(sorted(items))
        self.spans.append(_spans(s, w, t, mask) if k else [])

    def columns(self) -> list[pa.Array]:
        return [pa.array(self.n_words, pa.int64()), pa.array(self.n_hit, pa.int64()),
                pa.array([h > 0 and 20 * h >= n for h, n in zip(self.n_hit, self.n_words)], pa.bool_()),
                pa.array(self.items, pa.list_(pa.string())),
                pa.array(self.spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]


def scan(docs: DataFrame, bench: DataFrame, window: int = WINDOW,
         max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` (which must have a string column ``text``) with the columns
    n_words, n_hit, contaminated, items and spans (code points of hit words)."""
    wins = cut(benchmark_windows(bench, window), "benchmark-windows")
    if wins.count() > max_broadcast_windows:
        return _scan_by_join(docs, wins)
    index: dict[int, dict] = {}
    for r in wins.collect():
        index.setdefault(r["size"], {}).setdefault(r["hash"], {}).setdefault(bytes(r["words"]), set()).add(r["item_id"])
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast({k: (np.sort(np.array(list(v), np.int64)), v) for k, v in index.items()})

    def make(b: pa.RecordBatch):
        found = _Found()
        for s in slices(b.column(at)):
            w = words(s, ALNUM)
            masks: dict[int, np.ndarray] = {}
            items: dict[int, set[str]] = {}
            for size, (keys, bodies) in shared.value.items():
                h = windows(w.hash, size).view(np.int64)
                if not len(h):
                    continue
                k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                for p in np.flatnonzero(keys[k] == h).tolist():
                    t = int(np.searchsorted(w.first, p, "right")) - 1
                    if p + size > w.first[t + 1]:
                        continue            # this run of words crosses into the next text
                    names = bodies[int(h[p])].get(_body(s, w, p, size))
                    if names:
                        m = masks.setdefault(t, np.zeros(int(w.first[t + 1] - w.first[t]), bool))
                        m[p - w.first[t]:p - w.first[t] + size] = True
                        items.setdefault(t, set()).update(names)
            for t in range(len(s.offsets) - 1):
                found.add(s, w, t, masks.get(t), items.get(t, ()))
        return pa.RecordBatch.from_arrays([*b.columns, *found.columns()], names=[*b.schema.names, *(f.name for f in FOUND)])
    return arrow_map(docs, make, T.StructType([*docs.schema.fields, *FOUND]))


def _scan_by_join(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """The same rows for a benchmark too large to broadcast: the windows of
    every text are joined with the items' windows on hash and words."""
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())     # at most ``window`` values
    cols = docs.columns
    rows = cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("text"),
                           F.monotonically_increasing_id().alias("n")), "decontaminate-rows")

    def make(b: pa.RecordBatch):
        ids = b.column(0).to_pylist()
        for s in slices(b.column(1)):
            w = words(s, ALNUM)
            for t in range(len(s.offsets) - 1):
                a, z = int(w.first[t]), int(w.first[t + 1])
                for size in sizes:
                    h = windows(w.hash[a:z], size).view(np.int64)
                    for lo in range(0, len(h), 1000):
                        part = h[lo:lo + 1000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[s.first + t]] * len(part), pa.int64()), pa.array(np.arange(lo, lo + len(part))),
                             pa.array([size] * len(part), pa.int32()), pa.array(part),
                             pa.array([_body(s, w, a + p, size) for p in range(lo, lo + len(part))], pa.binary())],
                            names=["n", "pos", "size", "hash", "words"])
    mine = arrow_map(rows.select("n", "text"), make, "n long, pos long, size int, hash long, words binary")
    hits = mine.join(wins, ["hash", "size", "words"]).groupBy("n").agg(
        F.collect_set(F.struct("pos", "size")).alias("at"), F.collect_set("item_id").alias("names"))
    joined = rows.join(hits, "n", "left").select("row", "text", "at", "names")

    def finish(b: pa.RecordBatch):
        at, names, found = b.column(2).to_pylist(), b.column(3).to_pylist(), _Found()
        for s in slices(b.column(1)):
            w = words(s, ALNUM)
            for t, n in enumerate(np.diff(w.first).tolist()):
                mask = np.zeros(n, bool)
                for x in at[s.first + t] or ():
                    mask[x["pos"]:x["pos"] + x["size"]] = True
                found.add(s, w, t, mask, names[s.first + t] or ())
        return pa.RecordBatch.from_arrays([b.column(0), *found.columns()], names=["row", *(f.name for f in FOUND)])
    out = arrow_map(joined, finish, T.StructType([joined.schema["row"], *FOUND]))
    return out.select("row.*", *[f.name for f in FOUND])


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows in one struct beside the text: no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("text").cast("string").alias("text"))


def remove(docs: DataFrame, bench: DataFrame, mode: str = "documents", window: int = WINDOW) -> DataFrame:
    """``documents``: drop contaminated documents, keep all others as they are.
    ``spans``: keep every document and cut its hit words out of the text.
    The columns are those of ``docs``."""
    if mode not in ("documents", "spans"):
        raise ValueError(mode)
    got = scan(_packed(docs), bench, window)
    if mode == "documents":
        return got.where(~F.col("contaminated")).select("_row.*")
    kept = F.expr("concat_ws('', transform(sequence(0, size(spans)), i -> substring(text, if(i = 0, 0, spans[i - 1].end) + 1, "
                  "if(i = size(spans), length(text), spans[i].start) - if(i = 0, 0, spans[i - 1].end))))")
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(kept)
    return got.select(*[text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])


def digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """One row per document row: the scan in digest columns."""
    got = scan(keyed(docs), bench)
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


#: DuckDB twin of :func:`digest`
DIGEST_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size, array_to_string(ws[p:p + least(13, len(ws)) - 1], ' ') AS body
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, p, array_to_string(ws[p:p + size - 1], ' ') AS body
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM w, sizes WHERE len(ws) >= size)),
hit AS (SELECT doc_id, p, size, item_id FROM dw JOIN bw USING (size, body)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
