"""Packing in many groups: equal rows spread, and little room is lost."""

import random

import pytest
from pyspark.sql import functions as F

from framelake.llm import packing, simhash
from tests.llm.conftest import ODD


def lengths(spark, values, same=False):
    rows = [(0 if same else k, 0, 0, int(n), 7) for k, n in enumerate(values)]
    return spark.createDataFrame(rows, packing.PIECES)


def whole(out, size):
    """Every piece once, no sequence too long, offsets without gaps."""
    rows = sorted((r.sequence_id, r.offset, r.length) for r in out.collect())
    at = {}
    for s, o, n in rows:
        assert o == at.get(s, 0)
        at[s] = o + n
    assert max(at.values()) <= size
    return len(at), [n for _, _, n in rows]


def test_equal_rows_spread_over_groups(spark):
    """20,000 rows that agree in everything."""
    pieces = lengths(spark, [300] * 20_000, same=True)
    groups = packing.numbered(pieces).groupBy(F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", "copy", F.lit(0)), F.lit(50))).count()
    assert groups.count() == 50 and groups.agg(F.max("count")).first()[0] < 600
    bins, got = whole(packing.pack(pieces, group_tokens=120_000), packing.SIZE)
    assert got == [300] * 20_000 and bins <= -(-20_000 // 6) * 1.01


@pytest.mark.parametrize("group_tokens", [1 << 16, 1 << 18, 1 << 30])
def test_rest_does_not_grow_with_the_groups(spark, group_tokens):
    rng = random.Random(8)
    values = [min(2048, int(rng.lognormvariate(5.5, 1.0)) + 1) for _ in range(12_000)]
    bins, got = whole(packing.pack(lengths(spark, values), group_tokens=group_tokens), packing.SIZE)
    assert sorted(got) == sorted(values)
    assert bins <= -(-sum(values) // packing.SIZE) * (1.004 if group_tokens == 1 << 16 else 1.002)


def test_pieces_that_fill_no_bin_end(spark):
    """Nothing can be saved: every deal leaves all bins open, and packing ends."""
    bins, _ = whole(packing.pack(lengths(spark, [1100] * 900), group_tokens=1 << 15), packing.SIZE)
    assert bins == 900


# fingerprints, word by word
def mixed(words, simhash_rows):
    sums, total = [0] * 128, 0
    for w in words:
        n = len(w.encode())
        v = 0 if n == 0 else 1 if n <= 3 else 4
        total += v
        for k, h in enumerate(simhash_rows[w]):
            for j in range(64):
                sums[64 * k + j] += v * (h >> j & 1)
    f = [sum((1 << j) for j in range(64) if 2 * sums[64 * k + j] > total) for k in (0, 1)]
    return f"{f[0]:016x}{f[1]:016x}"


def test_fingerprints_equal_brute_force(spark, make_docs):
    rows = [r for r in ODD if not (r[1] and len(r[1]) > 100_000)] + [(20 + k, f"Some words of text {k} Über déjà\tvu\n{'again ' * k}") for k in range(9)]
    docs = sorted(((i, t or "") for i, t in ((r[0], r[1]) for r in rows) if i is not None), key=lambda r: r[0])
    docs = [d for k, d in enumerate(docs) if k == 0 or d[0] != docs[k - 1][0]]       # one row an id, so the order is plain
    split = lambda t: [w for w in __import__("re").split("[ \n\t\r\f\v]", t.lower())]
    edited = []
    for k, (_, t) in enumerate(docs):
        nxt, half = docs[(k + 1) % len(docs)][1], len(t) // 2
        edited.append(t[:len(t) - half] + nxt[:half])
    every = sorted({w for t in [*(t for _, t in docs), *edited] for w in split(t)})
    hashed = {r.w: (r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in spark.createDataFrame([(w,) for w in every], "w string")
              .select("w", F.xxhash64("w").alias("a"), F.xxhash64("w", F.lit(1)).alias("b")).collect()}
    prints = [mixed(split(t), hashed) for _, t in docs]
    other = [mixed(split(t), hashed) for t in edited]
    alike = lambda x, y: 1 - bin(int(x, 16) ^ int(y, 16)).count("1") / 128
    got = {r.doc_id: r for r in simhash.digest(make_docs(docs)).collect()}
    for k, (i, t) in enumerate(docs):
        r = got[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(t), prints[k], other[k])
        assert r.near_edited == pytest.approx(alike(prints[k], other[k])) and r.near_next == pytest.approx(alike(prints[k], prints[(k + 1) % len(docs)]))
