"""Fuzzy substring deduplication by collinear chaining (operator 4).

Texts become words; the least hash of every window of word k-mers is a seed.
A seed that several documents share pairs each of them with one of them, the
holder (that of the least row key), so a passage of very many copies gives
matches in proportion to its copies.  The matches of a document and a holder
are chained: of all ordered runs of matches, the best by matched words less
gap costs, found with a Fenwick tree of prefix maxima.  Chains are aligned
word by word, and of each the longest parts that are alike enough count,
stretched at both ends: unlike words between two passages part them.  Where holders differ along a
passage, it comes in pieces, so what counts is a run of words that pieces
cover without a break, from either side: runs of ``MIN_WORDS`` are passages.

A second round takes the seeds that no passage covers in some row, at all
their places, and with them the runs of ``LONG`` words that start there.  Rows
that share 40 words share a holder of those 40, so phrases that a row of lower
key has too hide no exact run of 51 words.  An edited passage without such a
run may stay hidden if its seeds and runs of 20 words have other holders.

A passage lies in two different rows; repeats inside one text are not looked
for.  Copies of a seed in a row meet those of the other by turns.  Null, empty and short texts have no passage.  Repeated rows hold each
other's text where ids or texts differ; equal rows of one id count as one.
Rows without an id take part but are not reported; a document whose partners
have no id is, with a null partner.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import Sieve, arrow_map, arrow_rows, cut, keyed
from framelake.llm.text_hash import ALNUM, mix, slices, windows, words

K = 5                 # words of a k-mer
WINDOW = 12           # k-mers of which one is a seed: shared runs of 16 words have a common seed
MIN_WORDS = 40        # of a passage
LONG = (20, 40)       # words of the runs that are seeds too: who shares these shares a piece, or a passage
MIN_PIECE = 20        # of a chain that takes part in one
REACH = 8             # words between the first and last seed of such a chain
MIN_ALIKE = 0.8       # matched words over the longer side
GAP = 0.08            # cost of a word between matches, on either side
CHAINS = "r long, lo long, xs array<int>, ys array<int>"


def seeds(docs: DataFrame, known: Sieve | None = None) -> DataFrame:
    """(seed, r, pos, nth, span): row key and word position of every seed, how
    many equal ones the row has before it, and 0.  With ``known``, only those
    that it may know, and for each the hashes of the runs of ``LONG`` words that
    start there, whose span is the distance of their first and last k-mer."""
    top = np.uint64(np.iinfo(np.uint64).max)
    bits = known.bits if known is not None else None

    def make(b: pa.RecordBatch):
        rows = b.column(0).to_numpy()
        for s in slices(b.column(1)):
            w = words(s, ALNUM)
            h = windows(w.hash, K)
            n = len(h)
            if n < WINDOW:
                continue
            owner = np.searchsorted(w.first, np.arange(n), "right") - 1
            stop = w.first[owner + 1] - K                       # last k-mer of the text
            h = np.where(np.arange(n) <= stop, h, top)
            least = h[:n - WINDOW + 1].copy()
            for d in range(1, WINDOW):
                np.minimum(least, h[d:n - WINDOW + 1 + d], out=least)
            least[np.arange(len(least)) + WINDOW - 1 > stop[:len(least)]] = 0      # such a window leaves the text
            most = np.zeros(n, np.uint64)
            for d in range(WINDOW):
                np.maximum(most[d:d + len(least)], least, out=most[d:d + len(least)])
            at = np.flatnonzero((most == h) & (h != top))
            if bits is not None:
                at = at[Sieve.hits(bits.value, h[at])]
            found = [(at, h[at], 0)]
            for size in LONG if bits is not None else ():
                own = at[at + size - K <= stop[at]]
                found.append((own, _runs(w.hash, own, size), size - K))
            for own, seed, span in found:
                if len(own):
                    t = owner[own]
                    yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(rows[s.first + t]), pa.array((own - w.first[t]).astype(np.int32)),
                                                      pa.array(_nth(t, seed)), pa.array(np.full(len(own), span, np.int32))],
                                                     names=["seed", "r", "pos", "nth", "span"])
    return arrow_map(docs, make, "seed long, r long, pos int, nth int, span int")


def _runs(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``windows(h, size)[at]``"""
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[at + j]
    return mix(out + np.uint64(size))


def _nth(text: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """How many equal seeds of the same text stand before each."""
    order = np.lexsort((np.arange(len(seed)), seed, text))
    t, s = text[order], seed[order]
    new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (s[1:] != s[:-1]))))
    out = np.empty(len(seed), np.int32)
    out[order] = np.arange(len(seed)) - np.repeat(new, np.diff([*new.tolist(), len(seed)]))
    return out


def chain(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Chains of matches (indexes), best first, no match in two of them.
    ``x`` ascends; within equal x, ``y`` descends."""
    n = len(x)
    ranks = np.unique(y, return_inverse=True)[1].tolist()
    xs, ys = x.tolist(), y.tolist()
    size = max(ranks) + 1
    tree_value, tree_at = [-1e18] * (size + 1), [-1] * (size + 1)       # Fenwick tree: prefix maxima over ranks of y
    score, parent = [0.0] * n, [-1] * n
    for i in range(n):
        best, at, k = -1e18, -1, ranks[i]                  # ranks below that of i
        while k > 0:
            if tree_value[k] > best:
                best, at = tree_value[k], tree_at[k]
            k -= k & -k
        paid = GAP * (xs[i] + ys[i])
        if at >= 0 and best - paid > 0:
            # overlapping k-mers match fewer new words than K
            score[i], parent[i] = min(K, xs[i] - xs[at], ys[i] - ys[at]) + best - paid, at
        if score[i] < K:
            score[i], parent[i] = float(K), -1
        value, k = score[i] + paid, ranks[i] + 1
        while k <= size:
            if value > tree_value[k]:
                tree_value[k], tree_at[k] = value, i
            k += k & -k
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        run = []
        while i >= 0 and not used[i]:
            used[i] = True
            run.append(i)
            i = parent[i]
        if len(run) > 1:
            out.append(run[::-1])
    return out


def chains(matches: DataFrame) -> DataFrame:
    """``matches``: r, lo, pos, rp.  Chains long enough to become a passage."""
    dealt = matches.repartition("r", "lo").sortWithinPartitions("r", "lo", "pos", F.desc("rp"))

    def done(t: pa.Table, edge: np.ndarray):
        new = np.ones(t.num_rows, bool)                    # a match may come from seeds of several lengths
        for c in ("r", "lo", "pos", "rp"):
            v = t[c].to_numpy()
            new[1:] = (v[1:] != v[:-1]) if c == "r" else new[1:] | (v[1:] != v[:-1])
        r, lo, x, y = (t[c].to_numpy()[new] for c in ("r", "lo", "pos", "rp"))
        edge = np.concatenate(([0], np.cumsum(new)))[edge]
        out: list[list] = [[], [], [], []]
        far = x[edge[1:] - 1] - x[edge[:-1]] >= REACH
        for a, z in zip(edge[:-1][far].tolist(), edge[1:][far].tolist()):
            for run in chain(x[a:z], y[a:z]):
                own = np.array(run) + a
                if x[own[-1]] - x[own[0]] >= REACH:
                    for col, v in zip(out, (r[a], lo[a], x[own], y[own])):
                        col.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int32()))],
                                             names=["r", "lo", "xs", "ys"])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            r, lo = t["r"].to_numpy(), t["lo"].to_numpy()
            edge = np.flatnonzero((r[1:] != r[:-1]) | (lo[1:] != lo[:-1])) + 1
            if not len(edge):
                held = t
                continue
            held = t.slice(int(edge[-1]))
            yield from done(t.slice(0, int(edge[-1])), np.concatenate(([0], edge)))
        if held is not None and held.num_rows:
            yield from done(held, np.array([0, held.num_rows]))
    return arrow_rows(dealt, run, CHAINS)


def align(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Bounds in both texts and matched words of the parts of a chain that are
    alike enough: for each match the longest part from it, unless that lies in
    another.  A chain that is alike as a whole is its one part.  ``a``, ``b``:
    word hashes of the texts; xs, ys: matches of K words."""
    x, y = np.array(xs, np.int64), np.array(ys, np.int64)
    hits = np.zeros(len(x), np.int64)                  # matched words up to each match
    broken = []                                        # links with unlike words
    for k, (p0, q0, p1, q1) in enumerate(zip(xs, ys, xs[1:], ys[1:])):
        p, q = a[p0:p1], b[q0:q1]
        if len(p) == len(q):
            same = int((p == q).sum())
            # equal lengths: word for word, unless most words moved
            hit = same if 2 * same >= len(p) else _common(p, q)
        else:
            hit = _common(p, q)
        hits[k + 1] = hits[k] + hit
        if hit < max(len(p), len(q)):
            broken.append(k)
    # words between broken links are alike, so a longest part has them all
    first, last = np.array([0, *[k + 1 for k in broken]]), np.array([*broken, len(x) - 1])
    left = np.array([_stretch(a[:xs[i]][::-1], b[:ys[i]][::-1]) for i in first.tolist()])
    right = np.array([_stretch(a[xs[j] + K:], b[ys[j] + K:]) for j in last.tolist()])
    out, done = [], -1
    for k, i in enumerate(first.tolist()):
        if done == len(first) - 1:
            break
        ends, far = last[k:], right[k:] + left[k]
        hit = hits[ends] - hits[i] + K + far
        n, m = x[ends] - x[i] + K + far, y[ends] - y[i] + K + far
        good = np.flatnonzero((np.minimum(n, m) >= MIN_PIECE) & (hit >= MIN_ALIKE * np.maximum(n, m)))
        if len(good) and k + int(good[-1]) > done:
            done = k + int(good[-1])
            j, t = int(last[done]), int(good[-1])
            out.append((xs[i] - int(left[k]), xs[j] + K + int(right[done]), ys[i] - int(left[k]), ys[j] + K + int(right[done]), int(hit[t])))
    return out


def _stretch(p: np.ndarray, q: np.ndarray) -> int:
    """Equal words at the start of both runs."""
    n, size = min(len(p), len(q)), 16
    while True:
        size = min(size, n)
        unlike = np.flatnonzero(p[:size] != q[:size])
        if len(unlike):
            return int(unlike[0])
        if size == n:
            return n
        size *= 4


def _common(p: np.ndarray, q: np.ndarray) -> int:
    """Longest common subsequence of two short runs, by increasing positions."""
    where: dict[int, list[int]] = {}
    for k, v in enumerate(q.tolist()):
        where.setdefault(v, []).insert(0, k)
    tails: list[int] = []
    for v in p.tolist():
        for k in where.get(v, ()):
            at = bisect_left(tails, k)
            tails[at:at + 1] = [k]
    return len(tails)


def passages(docs: DataFrame) -> DataFrame:
    """Pieces (doc_id, start, end, other_id, other_start, other_end, matched):
    word positions, ends exclusive; ``other_id`` is the holder."""
    rows = (keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
            .select(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "h").alias("r"), "text", "doc_id")
            # rows without an id have the greatest keys: they are holders only of what no other row has
            .withColumn("r", F.shiftright("r", 2) + F.when(F.col("doc_id").isNull(), F.lit(1 << 62)).otherwise(F.lit(0))))
    found = seeds(rows.select("r", "text")).select("seed", "r", "pos")
    shared = cut(found.groupBy("seed").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi").select("seed", "lo"), "passage-shared")
    held = cut(found.join(shared, "seed"), "passage-seeds")
    first = cut(held.where("r = lo").groupBy("seed").agg(F.min("pos").alias("rp")), "passage-first")
    pieces = cut(_pieces(rows, held.where("r <> lo").join(first, "seed").select("r", "lo", "pos", "rp")), "passage-pieces")

    # seeds that no passage covers somewhere: with all their places, and the long runs from there
    covered = spans(pieces.select("r", "start", "end").union(pieces.select("lo", "other_start", "other_end")), "r")
    bare = held.join(covered, "r", "left").where(F.expr(f"runs is null or not exists(runs, s -> s.start <= pos and pos + {K} <= s.end)")).select("seed")
    again = cut(_pieces(rows, long_matches(seeds(rows.select("r", "text"), Sieve(bare, "seed", hashed=True)))), "passage-again")
    return pieces.union(again).drop("r", "lo")


def long_matches(keys: DataFrame) -> DataFrame:
    """(r, lo, pos, rp) of seeds and long runs, all their places on both sides."""
    keys = cut(keys, "passage-keys")
    pairs = cut(keys.groupBy("seed").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi"), "passage-pairs")
    held = keys.join(pairs, "seed")
    # a row pairs with the holder, and a holder that has a seed again and again with one other row
    held = cut(held.withColumn("other", F.when(F.col("r") != F.col("lo"), F.col("lo")).otherwise(F.col("hi"))), "passage-held")
    ends = held.where("r = lo or r = hi")
    many = cut(ends.groupBy("seed", F.col("r").alias("other")).agg((F.max("nth") + 1).alias("many")), "passage-many")
    places = ends.groupBy("seed", F.col("r").alias("other"), F.col("nth").alias("turn")).agg(F.min("pos").alias("rp"))
    twice = many.where("many > 1").select("seed", F.col("other").alias("r"))
    asked = held.where("r <> lo").unionByName(held.where("r = lo").join(twice, ["seed", "r"], "left_semi"))
    # copies go by turns to those of the other row: with equal counts each meets its like, else all of the fewer are met
    asked = asked.join(many, ["seed", "other"]).withColumn("turn", F.expr("nth % many")).join(places, ["seed", "other", "turn"])
    # a long run gives a match at either end
    both = F.explode(F.when(F.col("span") > 0, F.array(F.lit(0), F.col("span"))).otherwise(F.array(F.lit(0))))
    return asked.select("r", F.col("other").alias("lo"), both.alias("d"), "pos", "rp").select("r", "lo", (F.col("pos") + F.col("d")).alias("pos"), (F.col("rp") + F.col("d")).alias("rp"))


def _pieces(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """The pieces of :func:`passages` with the keys ``r`` and ``lo`` of their rows."""
    runs = cut(chains(matches).distinct(), "passage-chains")

    # the words of both sides: first the document's, cut to what the chain can use
    texts = rows.select("r", "text", "doc_id")
    mine = Sieve(runs, "r").take(texts).dropDuplicates(["r"]).join(runs, "r").select("r", "lo", "doc_id", "text", "xs", "ys")

    def near(b: pa.RecordBatch):
        xs, hashes, at = b.column(4).to_pylist(), [], []
        for i, h in _texts(b.column(0), b.column(3)):
            lo, hi = max(0, xs[i][0] - WINDOW - K), xs[i][-1] + 2 * K + WINDOW
            at.append(lo)
            hashes.append(h[lo:hi].tobytes())
        return pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(at, pa.int32()), pa.array(hashes, pa.binary()), b.column(4), b.column(5), b.column(0)],
                                          names=["lo", "doc_id", "at", "hashes", "xs", "ys", "r"])
    cuts = cut(arrow_map(mine, near, "lo long, doc_id long, at int, hashes binary, xs array<int>, ys array<int>, r long"), "passage-cuts")
    # a holder may have very many chains: as a table, it joins in an exchange that Spark can split
    other = cut(Sieve(runs, "lo").take(texts.select(F.col("r").alias("lo"), "text", F.col("doc_id").alias("other_id"))).dropDuplicates(["lo"]), "passage-holders")
    both = cuts.join(other, "lo").select("lo", "text", "doc_id", "other_id", "at", "hashes", "xs", "ys", "r")

    def finish(b: pa.RecordBatch):
        at, xs, ys = b.column(4).to_pylist(), b.column(6).to_pylist(), b.column(7).to_pylist()
        ids, others, r, lo, out = b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(8).to_pylist(), b.column(0).to_pylist(), []
        for i, h in _texts(b.column(0), b.column(1)):
            a = np.frombuffer(b.column(5)[i].as_buffer(), np.uint64)
            for x0, x1, y0, y1, hit in align(a, h, [x - at[i] for x in xs[i]], ys[i]):
                out.append((ids[i], x0 + at[i], x1 + at[i], others[i], y0, y1, hit, r[i], lo[i]))
        cols = list(zip(*out)) if out else [[]] * 9
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "end", "other_id", "other_start", "other_end", "matched", "r", "lo"])
    return arrow_map(both, finish, "doc_id long, start long, end long, other_id long, other_start long, other_end long, matched long, r long, lo long")


def _texts(keys: pa.Array, column: pa.Array):
    """(row, word hashes) of every text; a text is hashed once where its rows
    follow each other."""
    key, last, h = keys.to_numpy(), None, None
    for i in range(len(column)):
        if key[i] != last:
            h = np.concatenate([words(s, ALNUM).hash for s in slices(column.slice(i, 1))] or [np.zeros(0, np.uint64)])
            last = key[i]
        yield i, h


def spans(sides: DataFrame, key: str) -> DataFrame:
    """(key, runs): for each key the runs of ``MIN_WORDS`` words that its
    pieces (key, start, end) cover without a break."""
    merged = F.expr("""aggregate(array_sort(collect_set(struct(start, end))), cast(array() as array<struct<start:bigint,end:bigint>>),
        (acc, s) -> if(size(acc) > 0 and s.start <= element_at(acc, -1).end,
                       concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, s.end) as end))),
                       concat(acc, array(s))))""")
    runs = sides.distinct().groupBy(key).agg(merged.alias("runs"))
    return runs.withColumn("runs", F.expr(f"filter(runs, s -> s.end - s.start >= {MIN_WORDS})")).where(F.size("runs") > 0)


def digest(docs: DataFrame) -> DataFrame:
    """One row for each document in a passage: what of it passages cover (word
    spans, joined where they touch) and its least partner (null if none has an id)."""
    got = cut(passages(docs), "passages")
    sides = got.select("doc_id", "start", "end", "other_id").union(got.select("other_id", "other_start", "other_end", "doc_id")).where("doc_id is not null")
    least = sides.groupBy("doc_id").agg(F.min("other_id").alias("other_id"))
    per_doc = spans(sides.select("doc_id", "start", "end"), "doc_id").join(least, "doc_id")
    return per_doc.select("doc_id", F.size("runs").cast("long").alias("n_spans"),
                          F.expr("aggregate(runs, 0L, (n, s) -> n + s.end - s.start)").alias("n_words_covered"),
                          F.expr("concat_ws(',', transform(runs, s -> concat(s.start, ':', s.end)))").alias("spans"), "other_id")
