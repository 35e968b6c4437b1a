"""N-gram Jaccard join (operator 6).

Texts become sets of word n-grams.  Equal sets are one class.  The n-grams of
a class are hashed into groups, and its counts per group are a point; the sum
of coordinate minima of two points bounds the overlap of their sets.

Two sets within the threshold share an n-gram among the first few of each
under any common order (their prefix), so classes meet by prefix n-gram, and
the n-grams from there on bound their overlap once more.  The order puts
n-grams last that many prefixes share under the plain order by hash; a bitmap
of fixed size holds them.  Classes that share a prefix n-gram form a cell.
First every class is tried against the class of its cells that meets most
others, which joins groups of copies in time that grows with their size, not
its square.  Then the cells in which several components are left, those of the
same classes merged into one, get an R-tree over their points that yields every
pair of different components that the bounds allow; a cell of more than
``CELL`` classes is dealt over pairs of its blocks.  A pair must also pass the
bitmaps of its sets: a bit that only one of them has stands for an n-gram the
other lacks.  All surviving pairs are verified by exact intersection of their
sets.  Links inside a component found before are implied and not tried again.

Words are hashed without the structure of a polynomial.  A class is the set
whose two 64-bit names agree; where two sets share the first name only, all is
done again with another seed.

Null and empty texts have no n-gram and link with nothing; a text of fewer
words is one n-gram.  A row with a null id links with nothing and has a null
component.  Repeated rows are of one class.  An empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import Sieve, arrow_map, arrow_rows, cut, keyed
from framelake.llm.components import components
from framelake.llm.rtree import LEAF, RTree, allowed, overlap_needed
from framelake.llm.text_hash import NOT_SPACE, mix, slices, windows, words

GROUPS = 128                # coordinates of a point
BITS_A_GRAM = 2             # of a set's bitmap, at least
COMMON = 32                 # an n-gram in as many prefixes goes last
CELL = 2048


def sets(column: pa.Array, n: int, seed: int = 0):
    """(row, sorted distinct n-gram hashes) of every text with a word."""
    for s in slices(column):
        w = words(s, NOT_SPACE, seed)
        runs = windows(w.hash, n)
        for t in range(len(s.offsets) - 1):
            a, z = int(w.first[t]), int(w.first[t + 1])
            if z - a >= n:
                yield s.first + t, np.unique(runs[a:z - n + 1])
            elif z > a:
                yield s.first + t, windows(w.hash[a:z], z - a)


def set_name(grams: np.ndarray, salt: int = 0x51) -> int:
    """64-bit name of a set: equal sets, equal names."""
    total = mix(grams + np.uint64(salt)).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(mix(np.array([total]))[0].astype(np.int64))


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Bits at the low bits of the n-grams; the size is a power of two of
    ``BITS_A_GRAM`` bits an n-gram or more."""
    n = max(64, 1 << (BITS_A_GRAM * len(grams) - 1).bit_length())
    bits = np.zeros(n, bool)
    bits[(grams & np.uint64(n - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def missing(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How many n-grams of each set the other lacks, at least."""
    n = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, n), axis=0).view(np.uint64) for x in (a, b))
    return int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())


def _points(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """One row per text: doc_id, size, both names, point and bitmap of its set."""
    def make(b: pa.RecordBatch):
        size, name, second, point, bits = [0] * b.num_rows, *([None] * b.num_rows for _ in range(4))
        for i, g in sets(b.column(1), n, seed):
            size[i], name[i], second[i] = len(g), set_name(g), set_name(g, 0xA7)
            point[i] = np.bincount((g >> np.uint64(57)).astype(np.int64), minlength=GROUPS).astype(np.int32)
            bits[i] = bitmap(g).tobytes()
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(name, pa.int64()), pa.array(second, pa.int64()), pa.array(point, pa.list_(pa.int32())), pa.array(bits, pa.binary())],
                                          names=["doc_id", "size", "name", "second", "point", "bits"])
    return arrow_map(docs, make, "doc_id long, size long, name long, second long, point array<int>, bits binary")


def _prefixes(docs: DataFrame, common: Sieve | None, n: int, seed: int, part: int, whole: int) -> DataFrame:
    """(gram, name, size, rest): the first n-grams of every set, as many as a
    partner can't avoid, and how many of the set are not before each.  A set
    that a batch holds again is not repeated."""
    bits = common.bits if common else None

    def run(batches):
        for b in batches:
            seen: set[int] = set()
            grams, names, sizes, rests = [], [], [], []
            for _, g in sets(b.column(1), n, seed):
                name = set_name(g)
                if name in seen:
                    continue
                seen.add(name)
                keep = len(g) - -(-part * len(g) // whole) + 1
                if bits is not None:                  # ``g`` is sorted: rare ones in order, then common ones
                    late = Sieve.hits(bits.value, g)
                    g = np.concatenate([g[~late], g[late]])
                grams.append(g[:keep].view(np.int64))
                names.append(np.full(keep, name, np.int64))
                sizes.append(np.full(keep, len(g), np.int32))
                rests.append(np.arange(len(g), len(g) - keep, -1, dtype=np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (grams, names, sizes, rests)], names=["gram", "name", "size", "rest"])
    return arrow_rows(docs, run, "gram long, name long, size int, rest int")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, seed: int, part: int, whole: int) -> DataFrame:
    """The pairs (a, b of names) that reach the threshold, by their sets."""
    need = cut(pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct().join(classes.select("name", "doc_id"), "name"), "jaccard-need")
    texts = Sieve(need, "doc_id").take(docs).join(need.select("doc_id").distinct(), "doc_id", "left_semi")

    def make(b: pa.RecordBatch):
        names, grams = [], []
        for _, g in sets(b.column(1), n, seed):
            names.append(set_name(g))
            grams.append(g.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(grams, pa.binary())], names=["name", "grams"])
    held = arrow_map(texts, make, "name long, grams binary").join(need.select("name"), "name", "left_semi")
    held = cut(held.dropDuplicates(["name"]), "jaccard-sets")
    met = (pairs.join(held.select(F.col("name").alias("a"), F.col("grams").alias("ga")), "a")
           .join(held.select(F.col("name").alias("b"), F.col("grams").alias("gb")), "b").select("a", "b", "ga", "gb"))

    def test(b: pa.RecordBatch):
        good = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(whole * both >= part * (len(x) + len(y) - both))
        return b.select(["a", "b"]).filter(pa.array(good))
    return arrow_map(met, test, "a long, b long")


def _bounded(pairs: DataFrame, classes: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs whose sizes and points allow the threshold."""
    side = lambda c: classes.select(F.col("name").alias(c), F.col("size").alias(f"n{c}"), F.col("point").alias(f"p{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    both = F.expr("aggregate(zip_with(pa, pb, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    return met.where((F.least("na", "nb") * whole >= F.greatest("na", "nb") * part) & (both * (whole + part) >= (F.col("na") + F.col("nb")) * part)).select("a", "b")


def _cells(rows: DataFrame, part: int, whole: int) -> DataFrame:
    """``rows``: gram, name, label, size, rest, point, bits, n (classes of the
    cell).  Pairs of different labels within a cell that the bounds allow."""
    blocks = F.ceil(F.col("n") / CELL).cast("int")
    home = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    cols = ["name", "label", "size", "rest", "point", "bits"]
    dealt = (rows.withColumn("blocks", blocks).withColumn("home", home)
             .select("gram", *cols, "home", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
             .select("gram", F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"), *cols)
             .repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j"))

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            key = np.stack([t[c].to_numpy().astype(np.int64) for c in ("gram", "i", "j")], 1)
            edge = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            done = int(edge[-1]) if len(edge) else 0          # the last cell may go on in the next batch
            held = t.slice(done)
            if done:
                yield from _pairs(t.slice(0, done), np.concatenate(([0], edge)), part, whole)
        if held is not None and held.num_rows:
            yield from _pairs(held, np.array([0, held.num_rows]), part, whole)
    return arrow_rows(dealt, run, "a long, b long").distinct()


def _pairs(cells: pa.Table, edge: np.ndarray, part: int, whole: int):
    """Pairs of whole cells (rows edge[k] .. edge[k + 1] - 1).  A cell that is
    one leaf needs no tree: such cells are tried side by side."""
    cells = cells.combine_chunks()
    names, labels = cells["name"].to_numpy(), cells["label"].to_numpy()
    sizes, limits = cells["size"].to_numpy().astype(np.int64), cells["rest"].to_numpy().astype(np.int64)
    points = cells["point"].combine_chunks().flatten().to_numpy().reshape(len(names), GROUPS)
    size = np.diff(edge)
    end = np.repeat(np.where(size <= LEAF, edge[1:], 0), size)
    found = []
    for d in range(1, LEAF):
        a = np.flatnonzero(np.arange(len(names)) + d < end)
        if not len(a):
            break
        found.append(allowed(points, sizes, labels, limits, a, a + d, part, whole))
    for k in np.flatnonzero(size > LEAF).tolist():
        own = slice(int(edge[k]), int(edge[k + 1]))
        tree = RTree(points[own], sizes[own], labels[own], limits[own])
        found += [(x + own.start, y + own.start) for x, y in tree.partners(part, whole)]
    if found:
        a, b = (np.concatenate(x) for x in zip(*found))
        need, bits = overlap_needed(sizes[a], sizes[b], part, whole), cells["bits"]
        maps = {i: np.frombuffer(bits[i].as_py(), np.uint8) for i in np.unique(np.concatenate([a, b])).tolist()}
        good = np.zeros(len(a), bool)
        for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            only_x, only_y = missing(maps[x], maps[y])
            good[k] = min(sizes[x] - only_x, sizes[y] - only_y) >= need[k]
        a, b = names[a[good]], names[b[good]]
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
        for k in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[k:k + 100_000, 0]), pa.array(pairs[k:k + 100_000, 1])], names=["a", "b"])


def join(docs: DataFrame, n: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: components of the
    links between texts whose sets of ``n``-word shingles have a Jaccard
    similarity of at least part/whole."""
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known, seed = rows.where("doc_id is not null"), 0
    while True:
        points = cut(_points(rows, n, seed), "jaccard-points")
        classes = cut(points.where("name is not null and doc_id is not null").groupBy("name")
                      .agg(F.min(F.struct("doc_id", "size", "point", "bits")).alias("r"), F.min("second").alias("lo"), F.max("second").alias("hi"))
                      .select("name", "r.*", "lo", "hi"), "jaccard-classes")
        if classes.where("lo <> hi").isEmpty():
            break
        seed += 1                  # two sets of one name
    common = _prefixes(known, None, n, seed, part, whole).groupBy("gram").agg(F.min("name").alias("lo"), F.max("name").alias("hi"), F.count("*").alias("n"))
    common = Sieve(cut(common.where(f"lo <> hi and n >= {COMMON}").select("gram"), "jaccard-common"), "gram", hashed=True)
    prefixes = _prefixes(known, common, n, seed, part, whole)
    shared = prefixes.groupBy("gram").agg(F.min("name").alias("lo"), F.max("name").alias("hi"), F.count("*").alias("n"))
    shared = cut(shared.where("lo <> hi").select("gram", "n"), "jaccard-shared")
    cells = cut(prefixes.join(shared, "gram").select("gram", "name", "size", "rest", "n"), "jaccard-cells")

    # every class against the one of its cells that meets most others
    meets = cut(cells.groupBy("name").agg(F.sum("n").alias("meets")), "jaccard-meets")
    center = cells.join(meets, "name").groupBy("gram").agg(F.max(F.struct("meets", F.col("name").alias("b"), F.col("size").alias("nb"), F.col("rest").alias("rb"))).alias("c"))
    center = cut(center.select("gram", "c.b", "c.nb", "c.rb"), "jaccard-center")
    star = cells.join(center, "gram").where(F.col("name") != F.col("b")).where(
        F.least("rest", "rb") * (whole + part) >= (F.col("size") + F.col("nb")) * part).select(F.col("name").alias("a"), "b").distinct()
    links = cut(_verify(cut(_bounded(star, classes, part, whole), "jaccard-star"), classes, rows, n, seed, part, whole), "jaccard-links")
    label = components(links)

    # cells in which several components are left
    cells = cells.groupBy("gram", "name").agg(F.first("rest").alias("rest")).join(label.withColumnRenamed("node", "name"), "name", "left")
    cells = cut(cells.select("gram", "name", "rest", F.coalesce("label", "name").alias("label")), "jaccard-labelled")
    mixed = (cells.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("name")).alias("members"))
             .where("lo <> hi").select("gram", "n", "members"))
    mixed = cut(mixed, "jaccard-mixed")
    # cells of the same classes are one (where only ``members`` agrees, one with more pairs); the loosest bound holds
    one = (cells.join(mixed, "gram").groupBy(F.xxhash64("members", "n").alias("gram"), "name")
           .agg(F.max("rest").alias("rest"), F.first("label").alias("label")))
    one = cut(one, "jaccard-merged")
    sized = one.groupBy("gram").agg(F.count("*").alias("n"))
    open_cells = one.join(sized, "gram").join(classes.select("name", "size", "point", "bits"), "name")
    pairs = cut(_cells(open_cells, part, whole), "jaccard-pairs")
    if not pairs.isEmpty():
        more = cut(_verify(pairs, classes, rows, n, seed, part, whole), "jaccard-more")
        if not more.isEmpty():
            label = components(links.unionByName(more))

    member = classes.select("name", "doc_id").join(label.withColumnRenamed("node", "name"), "name", "left")
    member = member.select("name", "doc_id", F.coalesce("label", "name").alias("label"))
    least = cut(member.groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    member = cut(member.join(least, "label").select("name", "component_id"), "jaccard-members")
    out = points.join(member, "name", "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"),
                      F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The rows of ``docs`` but for all of each component except its least id
    (one row of it where the id repeats).  Rows without a word or id stay."""
    got = cut(join(docs, n, part, whole), "jaccard-join")
    gone = cut(got.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
    many = cut(got.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "jaccard-repeats")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    # only rows that may have to go, or to be told apart, are shuffled
    sieve = Sieve(gone.union(many), "doc_id")
    some = sieve.take(rows).join(gone, "doc_id", "left_anti")
    if not many.isEmpty():
        again = some.join(many, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        some = some.join(many, "doc_id", "left_anti").unionByName(again)
    return sieve.take(rows, passing=False).unionByName(some).select("_row.*")


def digest(docs: DataFrame) -> DataFrame:
    return join(docs, n=4, part=85)


#: DuckDB twin of :func:`digest`
DIGEST_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + least(4, len(ws)) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(least(w.doc_id, coalesce(r.m, w.doc_id)) AS BIGINT) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) r USING (doc_id)
"""
