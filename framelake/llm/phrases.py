"""Phrase collocation mining (operator 12).

Suffix pointers (the next words at each place of a piece of text) are sorted
by a multikey three-way quicksort down to ``DEPTH`` words.  The weight of an
equal partition is the count of its phrase; a partition that weighs less than
``least`` can hold no phrase and is abandoned.  Three passes over the texts,
each pruned by the last one through a bitmap of fixed size:

1. words are counted and get a 64-bit id; the ids are checked on the whole
   vocabulary, and another seed is taken where two words share one,
2. suffixes of two frequent words are routed by both words and sorted,
3. suffixes of three or four words whose pairs are frequent are routed by
   their three leading words and sorted.

Equal suffixes of a chunk of text are one row with a weight, so a passage that
a third of all rows hold is routed as one row a chunk, and a frequent word is
split by the words after it.

Defined results: null text counts as empty, null ``lang`` as ``und``.  Words
are bytes, so any code point beyond ASCII is part of a word.  Repeated rows
count again.  Texts without words and empty tables give no phrases.  Ties of
the ranking are broken by phrase in UTF-8 byte order, which is unique within a
language.  Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import Sieve, cut
from framelake.llm.text_hash import LOWER, mix
from framelake.session import ship_package

DEPTH = 4
LEAST = 30
TOP = 2000
COVERED = 80                   # percent of a phrase's count that a longer one may have
CHUNK_BYTES = 8 << 20         # text sorted at once in a task
SORTED = 4096                  # partitions up to this size are sorted outright
PARTITION_ROWS = 4 << 20       # rows a task sorts at most, on average
IDS = [f"w{k}" for k in range(1, DEPTH + 1)]

_B = np.arange(256)
#: pieces end at [.,;:!?\x0A-\x0D]
PIECE_END = np.isin(_B, np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
#: words [^\x20\x09]+ of a piece
WORD_END = PIECE_END | (_B == 0x20) | (_B == 0x09)


class Chunk:
    """Words of some texts: codes into ``words`` (distinct, per language), the
    word's language and whether it follows the one before it in its piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data, offs = LOWER[data[offs[0]:offs[-1]]], offs - offs[0]
        word = ~WORD_END[data]
        edge = np.zeros(len(data) + 1, bool)             # a text begins here
        edge[offs] = True
        before = np.concatenate(([False], word[:-1])) if len(data) else word
        start = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.concatenate((word[1:], [False])) if len(data) else word
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        breaks = np.cumsum(PIECE_END[data]) if len(data) else np.zeros(0, np.int64)
        text = np.searchsorted(offs, start, "right") - 1
        same = (text[1:] == text[:-1]) & (breaks[start[1:]] == breaks[start[:-1]])
        self.follows = np.concatenate(([False], same)) if len(start) else np.zeros(0, bool)
        length = np.concatenate(([0], np.cumsum(end - start)))
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(length), pa.py_buffer(data[word].tobytes())])
        coded = packed.dictionary_encode()
        lang = langs.dictionary_encode()
        # a word of two languages is two words
        n = max(1, len(coded.dictionary))
        both = lang.indices.to_numpy().astype(np.int64)[text] * n + coded.indices.to_numpy()
        pairs, self.code = np.unique(both, return_inverse=True)
        self.words = coded.dictionary.take(pa.array(pairs % n)).to_pylist()
        self.langs = lang.dictionary.take(pa.array(pairs // n)).to_pylist()

    def ids(self, seed: int) -> np.ndarray:
        """An id of each distinct word, never 0."""
        import xxhash
        return np.array([xxhash.xxh3_64_intdigest(w, seed=xxhash.xxh3_64_intdigest(g, seed=seed)) or 1
                         for g, w in zip(self.langs, self.words)], np.uint64)


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Batches of (lang, text) as chunks of about ``limit`` bytes; a longer
    text is a chunk of its own."""
    held: list[pa.RecordBatch] = []
    size = 0

    def made():
        t = pa.Table.from_batches(held).combine_chunks()
        return Chunk(*(c.chunk(0) if c.num_chunks else pa.array([], pa.string()) for c in t.columns))
    for b in batches:
        at = 0
        while at < b.num_rows:
            ends = np.cumsum(pc.binary_length(b.column(1).slice(at)).to_numpy(zero_copy_only=False)) + size
            n = max(1, int(np.searchsorted(ends, limit, "right")))
            held.append(b.slice(at, n))
            at += n
            size = int(ends[min(n, len(ends)) - 1])
            if size >= limit or at < b.num_rows:
                yield made()
                held.clear()
                size = 0
    if held:
        yield made()


def suffixes(code: np.ndarray, follows: np.ndarray, good: np.ndarray, depth: int) -> np.ndarray:
    """Codes plus 1 of the ``depth`` words at each place, 0 beyond the end of
    a piece or from a word on that isn't ``good`` (by code)."""
    n = len(code)
    out = np.zeros((n, depth), np.int64)
    alive = good[code] if n else np.zeros(0, bool)
    out[:, 0] = np.where(alive, code + 1, 0)
    for d in range(1, depth):
        alive = alive[:-1] & follows[d:] & good[code[d:]] if d < n else np.zeros(0, bool)
        out[:len(alive), d] = np.where(alive, code[d:] + 1, 0)
    return out


def merged(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    key = np.zeros(len(rows), np.int64)          # columns are folded one by one, so the key stays below rows * words
    for d in range(rows.shape[1]):
        key = np.unique(key * (int(rows[:, d].max()) + 1) + rows[:, d], return_inverse=True)[1]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return rows[first], n


def frequent_prefixes(words: list[np.ndarray], weight: np.ndarray, least: int, leading: int = 1) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to suffixes (``words[d]``: the
    word at depth d, 0 past the end).  Yields (pointer, depth, weight) for
    each prefix of ``leading`` or more words that weighs ``least`` or more."""
    depth = len(words)
    stack = [(np.arange(len(weight)), 0)]
    while stack:
        at, d = stack.pop()
        if len(at) == 0 or weight[at].sum() < least:          # abandoned
            continue
        key = words[d][at]
        if len(at) <= SORTED:                                 # equal runs of a small partition
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sums = np.add.reduceat(weight[at], run)
            ends = np.append(run[1:], len(at))
            found = [(at[a:z], int(s)) for a, z, s, k in zip(run, ends, sums, key[run]) if k and s >= least]
        else:
            pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
            equal = key == pivot
            stack.append((at[key < pivot], d))
            stack.append((at[key > pivot], d))
            found = [(at[equal], int(weight[at[equal]].sum()))] if pivot else []
        for same, total in found:
            if total < least:
                continue
            if d + 1 >= leading:
                yield int(same[0]), d + 1, total
            if d + 1 < depth:
                stack.append((same, d + 1))


def _mapped(docs: DataFrame, make, schema: str) -> DataFrame:
    """``make`` over chunks of (lang, text)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for c in chunks(batches):
            if len(c.code):
                yield make(c)
            del c
            pa.default_memory_pool().release_unused()
    return rows.mapInArrow(run, schema)


def count_words(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, int]:
    """Words that occur ``least`` times (lang, word, id, f), the number of all
    words by language (lang, n), and the seed of the ids."""
    seed = 0
    while True:
        def make(c: Chunk, seed=seed):
            ids = c.ids(seed).view(np.int64)
            n = np.bincount(c.code, minlength=len(ids))
            return pa.RecordBatch.from_arrays([pa.array(c.langs, pa.string()), pa.array(c.words, pa.binary()), pa.array(ids), pa.array(n, pa.int64())], names=["lang", "word", "id", "f"])
        words = cut(_mapped(docs, make, "lang string, word binary, id long, f long").groupBy("lang", "word", "id").agg(F.sum("f").alias("f")), "phrase-words")
        # an id is unsound where it stands for two words, one of them frequent
        shared = words.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.max("f").alias("f")).where((F.col("words") > 1) & (F.col("f") >= least))
        if not shared.limit(1).count():
            break
        seed += 1
    return words.where(F.col("f") >= least), words.groupBy("lang").agg(F.sum("f").alias("n")), seed


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sieve hash of two word ids."""
    return mix(mix(a) + b)


def route(docs: DataFrame, depth: int, leading: int, least: int, seed: int, words: Sieve, pairs: Sieve | None) -> DataFrame:
    """Phrases of ``leading`` to ``depth`` words (w1, w2, ..., a) that occur
    ``least`` times: suffixes routed by their leading words and sorted."""
    word_bits, pair_bits = words.bits, pairs.bits if pairs else None
    cols = IDS[:depth]

    def make(c: Chunk):
        ids = c.ids(seed)
        rows = suffixes(c.code, c.follows, Sieve.hits(word_bits.value, mix(ids)), depth)
        by_code = np.concatenate((np.zeros(1, np.uint64), ids))
        if pair_bits is not None:       # a suffix ends where a pair isn't frequent
            alive = np.ones(len(rows), bool)
            for d in range(1, depth):
                alive &= rows[:, d] > 0
                at = np.flatnonzero(alive)
                alive[at] = Sieve.hits(pair_bits.value, pair_key(by_code[rows[at, d - 1]], by_code[rows[at, d]]))
                rows[~alive, d:] = 0
        rows, n = merged(rows[rows[:, leading - 1] > 0])
        return pa.RecordBatch.from_arrays([pa.array(by_code[rows[:, d]].view(np.int64)) for d in range(depth)] + [pa.array(n, pa.int64())], names=[*cols, "weight"])
    schema = ", ".join(f"{c} long" for c in [*cols, "weight"])
    # written first: the number of partitions follows from the rows
    sent = cut(_mapped(docs, make, schema), "phrase-suffixes")
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sent.count() // PARTITION_ROWS))
    dealt = sent.repartition(parts, *cols[:leading])

    def sort(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        del held
        ids, weight = [t.column(d).to_numpy() for d in range(depth)], t.column(depth).to_numpy()
        out: list[list[int]] = [[] for _ in range(depth + 1)]
        for at, d, total in frequent_prefixes(ids, weight, least, leading):
            for k in range(depth):
                out[k].append(int(ids[k][at]) if k < d else 0)
            out[depth].append(total)
            if len(out[0]) >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=[*cols, "a"])
                out = [[] for _ in range(depth + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=[*cols, "a"])
    return dealt.mapInArrow(sort, ", ".join(f"{c} long" for c in [*cols, "a"]))


def _sieve(rows: DataFrame, key) -> Sieve:
    """A sieve of the hash ``key`` makes of the id columns of ``rows``."""
    def run(batches):
        for b in batches:
            h = key(*(c.to_numpy().view(np.uint64) for c in b.columns))
            yield pa.RecordBatch.from_arrays([pa.array((h & np.uint64(Sieve.SLOTS - 1)).astype(np.int64))], names=["h"])
    return Sieve(rows.mapInArrow(run, "h long"), "h", hashed=True)


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words (w1..w4, a; unused ids are 0) that occur
    ``least`` times, with lang and word of the single ones; and words by lang."""
    words, totals, seed = count_words(docs, least)
    word_sieve = _sieve(words.select("id"), mix)
    pairs = cut(route(docs, 2, 2, least, seed, word_sieve, None), "phrase-pairs")
    longer = route(docs, DEPTH, 3, least, seed, word_sieve, _sieve(pairs.select("w1", "w2"), pair_key))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    one = words.select(F.col("id").alias("w1"), zero.alias("w2"), zero.alias("w3"), zero.alias("w4"), F.col("f").alias("a"), "lang", F.col("word").cast("string").alias("word"))
    two = pairs.select("w1", "w2", zero.alias("w3"), zero.alias("w4"), "a", none.cast("string").alias("lang"), none.cast("string").alias("word"))
    more = longer.select(*IDS, "a", none.cast("string").alias("lang"), none.cast("string").alias("word"))
    return cut(one.unionByName(two).unionByName(more), "phrase-counts"), cut(totals, "phrase-totals")


def _parts(size: int) -> list[tuple[int, int]]:
    """(start, length) of the contiguous parts of a phrase, itself left out."""
    return [(s, n) for n in range(1, size) for s in range(size - n + 1)]


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, salts: int = 64) -> DataFrame:
    """The ``top`` phrases of each language."""
    counts, totals = count_phrases(docs, least)
    ids = F.array_remove(F.array(*IDS), 0)
    phrases = counts.where("w2 <> 0").select(F.xxhash64(*IDS).alias("_salt"), ids.alias("ids"), "a")

    # every part of every phrase: what a cut needs, and what a longer phrase covers
    def parts(size):
        return F.array(*[F.struct(F.lit(s).alias("s"), F.lit(n).alias("k"), F.slice("ids", s + 1, n).alias("part")) for s, n in _parts(size)])
    split = (phrases.withColumn("_p", F.explode(F.when(F.size("ids") == 2, parts(2)).when(F.size("ids") == 3, parts(3)).otherwise(parts(4))))
             .select("ids", "a", "_p.s", "_p.k", "_p.part"))
    longer = split.where("k >= 2").groupBy(F.col("part").alias("ids")).agg(F.max("a").alias("longest"))
    known = counts.select(ids.alias("part"), F.col("a").alias("f"), "lang", "word")
    got = (split.join(known, "part").groupBy("ids", "a")
           .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("s", "k"), F.struct("f", "lang", "word")))).alias("m")))
    at = lambda s, n: F.col("m")[F.struct(F.lit(s).alias("s"), F.lit(n).alias("k"))]
    big = lambda c: c.cast("decimal(20,0)")

    def cuts(size):
        out = []
        for k in range(1, size):
            l, r = at(0, k)["f"], at(k, size - k)["f"]
            score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * big(F.col("a")), big(l) + big(r)).cast("long")
            out.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
        return F.array_min(F.array(*out))
    size = F.size("ids")
    words = F.array(*[at(k, 1)["word"] for k in range(DEPTH)])
    scored = (got.select("ids", "a", at(0, 1)["lang"].alias("lang"), F.array_join(F.slice(words, F.lit(1), size), " ").alias("phrase"),
                         F.when(size == 2, cuts(2)).when(size == 3, cuts(3)).otherwise(cuts(4)).alias("cut"))
              .join(longer, "ids", "left")
              .where(F.col("longest").isNull() | (F.lit(100).cast("decimal(3,0)") * big(F.col("longest")) < F.lit(covered).cast("decimal(3,0)") * big(F.col("a"))))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.hash("ids"), F.lit(salts)).alias("_salt")))
    # the first of each salt hold the first of all
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = (scored.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_at") <= top).drop("_at", "_salt"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    return mine(docs)


def _digest_sql() -> str:
    """The same counts from every position of every piece."""
    def rows(k):
        words = ", ".join(f"ws[i + {j}]" for j in range(k))
        return f"SELECT lang, list_value({words}) AS p FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM t)"
    grams = " UNION ALL ".join(rows(k) for k in range(1, DEPTH + 1))
    cuts = " UNION ALL ".join(f"SELECT lang, p, a, {k} AS k, p[1:{k}] AS x, p[{k + 1}:] AS y FROM c WHERE len(p) > {k}" for k in range(1, DEPTH))
    inner = " UNION ALL ".join(f"SELECT lang, p[{s + 1}:{s + n}] AS q, a FROM c WHERE len(p) = {size}" for size in (3, 4) for s, n in _parts(size) if n >= 2)
    return rf"""
WITH t AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (SELECT lang, p, count(*) AS a FROM ({grams}) GROUP BY lang, p),
c AS (SELECT * FROM f WHERE len(p) >= 2 AND a >= {LEAST}),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
s AS (
  SELECT u.lang, u.p, u.a, u.k, fx.a AS l, fy.a AS r,
         CAST((2000000::HUGEINT * u.a::HUGEINT) // (fx.a::HUGEINT + fy.a::HUGEINT) AS BIGINT) AS score
  FROM ({cuts}) u JOIN f fx ON fx.lang = u.lang AND fx.p = u.x JOIN f fy ON fy.lang = u.lang AND fy.p = u.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
g AS (SELECT lang, q, max(a) AS longest FROM ({inner}) GROUP BY lang, q),
k AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN g ON g.lang = b.lang AND g.q = b.p
  WHERE g.longest IS NULL OR 100::HUGEINT * g.longest::HUGEINT < {COVERED}::HUGEINT * b.a::HUGEINT)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n, score
FROM k JOIN n ON n.lang = k.lang
QUALIFY rank <= {TOP}
"""


DIGEST_SQL = _digest_sql()
