"""Exact substring deduplication (operator 5).

Every byte covered by a string of ``length`` bytes that also starts elsewhere
is removed.  Positions get ranks (names of the string that starts there) at
growing lengths; positions whose name is unique leave, those whose whole
string has a partner are done, the others go on to the next length.

Neighbouring positions are named together, which keeps this affordable.  A
position belongs to the first content-defined anchor at or after it (a place
whose next 8 bytes hash to zero; in sparse stretches a place of a denser kind,
else the position itself) and has an offset to it.  Equal strings have equal
anchors and offsets, so only positions with the same offset can be partners.
A unit is a run of positions of one anchor inside a cell of ``width`` offsets.
Its core is the part that all positions of the cell share, its hull what they
span.  A unit whose core is unique holds no repeated string; one whose hull is
repeated holds only repeated strings; any other unit is split into cells of
the next width: 128, 16, 1, that is, strings known to 273, 385 and all 400
bytes.  Names are 64-bit hashes.

Matches never cross documents.  Null and empty texts have no bytes; texts
shorter than ``length`` stay whole.  Repeated rows are occurrences of each
other, also under one id, so they go entirely where they are long enough.  An
empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import Sieve, arrow_map, cut, keyed
from framelake.llm.text_hash import SLICE_BYTES, mix, part_hash, powers, prefix_hash, slices

LENGTH = 400
WIDTHS = (128, 16, 1)
GRAM = 8                    # bytes that decide whether a place is an anchor
RARE, DENSE = 7, 4          # anchors are one place in 2**RARE, or 2**DENSE
UNITS = "core long, hull long, doc_id long, h long, p long"
BLOCK = SLICE_BYTES         # window starts handled at once in a long text


def blocks(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of bytes with, per text or part of a long text: row, byte offset
    in the text, first and last window start in the run."""
    for s in slices(column):
        size = np.diff(s.offsets)
        if len(size) == 1 and size[0] > 2 * BLOCK:
            for at in range(0, int(size[0]) - length + 1, BLOCK):
                data = s.data[at:at + BLOCK + length - 1]
                yield data, np.array([s.first]), np.array([at]), np.array([0]), np.array([len(data) - length])
            continue
        long = np.flatnonzero(size >= length)
        if len(long):
            yield s.data, s.first + long, np.zeros(len(long), np.int64), s.offsets[long], s.offsets[long + 1] - length


def find_units(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int):
    """(anchor, least offset, greatest offset, tier) of all window starts."""
    n, reach = len(data), length - GRAM
    q = prefix_hash(data)
    _, inv = powers(n + 1)
    gram = (q[GRAM:] - q[:-GRAM]) * inv[:n - GRAM + 1]
    rare = np.flatnonzero((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - RARE) == 0)
    piece = np.searchsorted(first, rare, "right") - 1
    ok = piece >= 0
    before = np.concatenate(([-1], rare[:-1]))
    lo = np.maximum.reduce([before + 1, first[np.maximum(piece, 0)], rare - reach])
    hi = np.minimum(rare, last[np.maximum(piece, 0)])
    ok &= lo <= hi
    rare, lo, hi = rare[ok], lo[ok], hi[ok]
    covered = np.zeros(n + 2, np.int8)           # +1 where starts begin, -1 after; minus what rare anchors take
    np.add.at(covered, first, 1)
    np.add.at(covered, last + 1, -1)
    np.add.at(covered, lo, -1)
    np.add.at(covered, hi + 1, 1)
    rest = np.flatnonzero(np.cumsum(covered, dtype=np.int8))
    out = [(rare, rare - hi, rare - lo, np.ones(len(rare), np.int64))]
    if len(rest):
        dense = np.flatnonzero((gram * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - DENSE) == 0)
        at = np.searchsorted(dense, rest)
        b = dense[np.minimum(at, len(dense) - 1)] if len(dense) else np.full(len(rest), -1)
        near = (at < len(dense)) & (b <= rest + reach)
        u, v = rest[near], b[near]
        if len(u):
            cut_at = np.flatnonzero((np.diff(v) != 0) | (np.diff(u) != 1)) + 1
            a, z = np.concatenate(([0], cut_at)), np.concatenate((cut_at, [len(u)])) - 1
            out.append((v[a], v[a] - u[z], v[a] - u[a], np.full(len(a), 2)))
        alone = rest[~near]
        out.append((alone, np.zeros(len(alone), np.int64), np.zeros(len(alone), np.int64), np.full(len(alone), 3)))
    return q, *(np.concatenate(x).astype(np.int64) for x in zip(*out))


def split_units(q, anchor, least, most, tier, width: int, length: int):
    """Units cut at the cells of ``width``: core and hull names and the units."""
    k0 = least // width
    count = most // width - k0 + 1
    src = np.repeat(np.arange(len(anchor)), count)
    k = k0[src] + np.arange(len(src)) - np.repeat(np.cumsum(count) - count, count)
    a, t = anchor[src], tier[src]
    lo, hi = np.maximum(least[src], k * width), np.minimum(most[src], k * width + width - 1)
    salt = (t << 32).astype(np.uint64)
    core = mix(part_hash(q, a - k * width, a - k * width - width + 1 + length) + salt + k.astype(np.uint64))
    hull = mix(part_hash(q, a - hi, a - lo + length) + salt + (lo << 16).astype(np.uint64) + hi.astype(np.uint64))
    return core.view(np.int64), hull.view(np.int64), a, lo, hi, t, src


def _pack(a, lo, hi, t) -> np.ndarray:
    return (a << 20) | (lo << 11) | (hi << 2) | t


def _unpack(p: np.ndarray):
    return p >> 20, (p >> 11) & 511, (p >> 2) & 511, p & 3


def _texts(docs: DataFrame) -> DataFrame:
    """A row's key is its id and the hash of its text: rows that agree in both
    have the same result."""
    rows = keyed(docs)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def all_units(docs: DataFrame, width: int, length: int) -> DataFrame:
    def make(b: pa.RecordBatch):
        ids, hs = b.column(0), b.column(1)
        for data, row, offset, first, last in blocks(b.column(2), length):
            q, a, lo, hi, t = find_units(data, first, last, length)
            core, hull, a, lo, hi, t, _ = split_units(q, a, lo, hi, t, width, length)
            piece = np.searchsorted(first, a - hi, "right") - 1
            at = pa.array(row[piece])
            yield pa.RecordBatch.from_arrays(
                [pa.array(core), pa.array(hull), ids.take(at), hs.take(at), pa.array(_pack(a - first[piece] + offset[piece], lo, hi, t))],
                names=["core", "hull", "doc_id", "h", "p"])
    return arrow_map(docs, make, UNITS)


def finer_units(docs: DataFrame, units: DataFrame, width: int, length: int) -> DataFrame:
    """``units`` (doc_id, h, p) split at ``width``, named from their texts."""
    per_row = units.groupBy("doc_id", "h").agg(F.collect_list("p").alias("ps"))
    texts = Sieve(per_row, "doc_id", "h").take(docs).dropDuplicates(["doc_id", "h"])
    joined = _meet(texts, per_row, "inner").select("doc_id", "h", "text", "ps")

    def make(b: pa.RecordBatch):
        ids, hs = b.column(0), b.column(1)
        for i in range(b.num_rows):
            data = np.frombuffer(b.column(2)[i].as_buffer(), np.uint8)
            a, lo, hi, t = _unpack(np.sort(b.column(3)[i].values.to_numpy()))
            group = (a - hi) // BLOCK                  # a long text is named part by part
            for g in np.unique(group):
                own = group == g
                base = int((a - hi)[own].min())
                q = prefix_hash(data[base:int((a - lo)[own].max()) + length])
                core, hull, x, y, z, w, _ = split_units(q, a[own] - base, lo[own], hi[own], t[own], width, length)
                at = pa.array(np.full(len(x), i))
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(hull), ids.take(at), hs.take(at), pa.array(_pack(x + base, y, z, w))],
                                                 names=["core", "hull", "doc_id", "h", "p"])
    return arrow_map(joined, make, UNITS)


def _meet(texts: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join on id and hash; a null id is a key like any other."""
    r = rows.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), *[c for c in rows.columns if c not in ("doc_id", "h")])
    return texts.join(r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), how)


def repeated(docs: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc_id, h, p): units all of whose strings have a partner."""
    found = None
    units = None
    for level, width in enumerate(widths):
        # the units of the whole corpus are named twice rather than stored; later there are few
        named = all_units(docs, width, length) if units is None else cut(finer_units(docs, units, width, length), f"units-{width}")
        again = cut(named.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), f"cores-{width}")
        alive = cut(named.join(again, "core", "left_semi"), f"alive-{width}")
        hulls = cut(alive.groupBy("hull").agg(F.count("*").alias("n")).where("n > 1").select("hull"), f"hulls-{width}")
        done = alive.join(hulls, "hull", "left_semi")
        part = done.select("doc_id", "h", "p")
        found = part if found is None else found.unionByName(part)
        if level == len(widths) - 1:
            return found
        # what is open may still match a part of a finished unit: one of each kind goes along
        open_units = cut(alive.join(hulls, "hull", "left_anti"), f"open-{width}")
        one = done.groupBy("core", "hull").agg(F.min(F.struct("doc_id", "h", "p")).alias("r"))
        open_cores = cut(open_units.select("core").distinct(), f"open-cores-{width}")
        partners = one.join(open_cores, "core", "left_semi").select("r.*")
        units = cut(open_units.select("doc_id", "h", "p").unionByName(partners).distinct(), f"next-{width}")
    return found


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, the removed byte spans, and what is kept (binary)."""
    texts = _texts(docs)
    found = cut(repeated(texts, length), "repeated")
    per_row = found.groupBy("doc_id", "h").agg(F.collect_set("p").alias("ps"))
    sieve = Sieve(found, "doc_id", "h")
    hit = _meet(sieve.take(texts), per_row, "left").select("doc_id", "text", "ps")
    rest = sieve.take(texts, passing=False).select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("ps"))

    def make(b: pa.RecordBatch):
        spans, kept = [], []
        for text, ps in zip(b.column(1), b.column(2)):
            data = text.as_buffer().to_pybytes()
            if not ps.is_valid:
                spans.append([])
                kept.append(data)
                continue
            a, lo, hi, _ = _unpack(ps.values.to_numpy())
            order = np.argsort(a - hi, kind="stable")
            s, e = (a - hi)[order], (a - lo + length)[order]
            top = np.maximum.accumulate(e)
            new = np.concatenate(([True], s[1:] > top[:-1]))
            s, e = s[new], np.concatenate((top[:-1][new[1:]], top[-1:]))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
            edge = [0, *np.stack([s, e], 1).ravel().tolist(), len(data)]
            kept.append(b"".join(data[x:y] for x, y in zip(edge[::2], edge[1::2])))
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(t.as_buffer()) for t in b.column(1)], pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])
    return arrow_map(hit.unionByName(rest), make, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


