"""Exact duplicates through a cuckoo-filter index (operator 11).

Texts are equal when they are the same after every run of white space became
one space.  The index holds one live key per different text: the digest of the
normalised text, the smallest ``doc_id`` that has it and the number of live
rows.  Keys are dealt over buckets by digest; each bucket has a cuckoo filter
of 16-bit fingerprints.  A digest that the filter misses is new, and its
fingerprint goes in.  A hit is looked up among the bucket's stored keys, and
the contents of all digests with more than one row are dealt into the buckets
and compared, so unequal texts never share a group, whatever the digest.  A
filter that overflows is built anew, twice as large, from the stored keys.
Deleting rows lowers a key's count; a key without rows leaves the filter.

Copies are combined before each shuffle, so a text that a third of all rows
hold reaches its bucket as a few rows.  A bucket's memory is bounded by its
different texts, about ``KEYS_PER_BUCKET``.

Defined results: null text counts as empty, and all empty texts are one group.
Repeated rows are separate rows of their group.  Of equal texts the row with
the smallest ``doc_id`` stays; null ids sort last; where that row is repeated,
one copy stays.  An empty table gives no rows.  Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import Sieve, cut, keyed
from framelake.session import ship_package

SPACES = r"[\x20\x09-\x0D]+"
KEYS_PER_BUCKET = 1 << 16     # different texts a bucket is made for
LEAST_BUCKETS = 1 << 12       # so that buckets spread evenly over tasks
COMBINED = 1 << 17            # keys combined in a task before they are sent on
START = 4                     # log2 of the cells of a new filter
CELL = 4                      # fingerprints of a cell
KICKS = 64                    # moves before an insertion counts as overflow
KEYS = "bucket int, digest binary, keep_id long, n long, stale boolean, cells int, held binary"


class CuckooFilter:
    """Fingerprints of 64-bit hashes in cells of four; each has two cells."""

    def __init__(self, log2: int = START, held: bytes | None = None):
        self.mask = (1 << log2) - 1
        self.log2 = log2
        self.held = array("H", held if held is not None else bytes(2 * CELL << log2))

    def _at(self, h: int) -> tuple[int, int]:
        return (h >> 48) or 1, h & self.mask

    def _other(self, cell: int, mark: int) -> int:
        return cell ^ ((mark * 0x5BD1E995) & self.mask)

    def _find(self, cell: int, mark: int) -> int:
        """Place of ``mark`` in a cell, or -1; mark 0 finds a free place."""
        at = cell * CELL
        for k in range(at, at + CELL):
            if self.held[k] == mark:
                return k
        return -1

    def may_hold(self, h: int) -> bool:
        mark, cell = self._at(h)
        return self._find(cell, mark) >= 0 or self._find(self._other(cell, mark), mark) >= 0

    def insert(self, h: int) -> bool:
        """False: overflow.  A fingerprint was then pushed out, so the filter
        has to be built anew."""
        mark, cell = self._at(h)
        for c in (cell, self._other(cell, mark)):
            k = self._find(c, 0)
            if k >= 0:
                self.held[k] = mark
                return True
        cell = self._other(cell, mark)
        for kick in range(KICKS):
            k = cell * CELL + (kick + mark) % CELL
            mark, self.held[k] = self.held[k], mark
            cell = self._other(cell, mark)
            free = self._find(cell, 0)
            if free >= 0:
                self.held[free] = mark
                return True
        return False

    def delete(self, h: int) -> None:
        """Only for a hash that was inserted."""
        mark, cell = self._at(h)
        k = self._find(cell, mark)
        self.held[k if k >= 0 else self._find(self._other(cell, mark), mark)] = 0


class Bucket:
    """Stored keys of a bucket (digest: [keep_id, rows, stale]) and their filter."""

    def __init__(self, log2: int = START, held: bytes | None = None):
        self.filter = CuckooFilter(log2, held)
        self.keys: dict[bytes, list] = {}

    @staticmethod
    def hash(digest: bytes) -> int:
        return int.from_bytes(digest[:8].rjust(8, b"\0"), "little")

    def _grow(self) -> None:
        """A filter of twice the size, or more, from the stored keys."""
        log2 = self.filter.log2
        while True:
            log2 += 1
            self.filter = CuckooFilter(log2)
            # more equal fingerprints than two cells hold: no size would part them
            if all(self.filter.insert(self.hash(d)) for d in self.keys):
                return
            if log2 > 30:
                raise OverflowError("digests of one bucket share their first 8 bytes")

    def insert(self, digest: bytes, doc_id: int | None, n: int) -> None:
        h = self.hash(digest)
        if self.filter.may_hold(h):
            row = self.keys.get(digest)          # a hit is verified among the stored keys
            if row is not None:
                row[1] += n
                if row[0] is None or (doc_id is not None and doc_id < row[0]):
                    row[0] = doc_id
                return
        self.keys[digest] = [doc_id, n, False]
        if not self.filter.insert(h):
            self._grow()

    def delete(self, digest: bytes, doc_id: int | None, n: int) -> None:
        h = self.hash(digest)
        row = self.keys.get(digest) if self.filter.may_hold(h) else None
        if row is None:
            return
        row[1] -= n
        row[2] = row[2] or row[0] == doc_id      # its keeper may be gone
        if row[1] <= 0:
            del self.keys[digest]
            self.filter.delete(h)


@dataclass(frozen=True)
class Index:
    """Live keys and filters by bucket (``keys``), live rows by digest and id
    (``members``) and the documents that hold their contents (``docs``)."""

    keys: DataFrame
    members: DataFrame
    docs: DataFrame
    buckets: int
    digest_of: Callable[[Column], Column]


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(docs: DataFrame, digest_of: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text (normalised), digest."""
    d = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    return d.withColumn("digest", digest_of(F.col("text")))


def _combined(members: DataFrame) -> DataFrame:
    """Rows of one digest joined within each task: smallest id, sum of rows."""
    def run(batches):
        held: dict[bytes, list] = {}

        def out():
            rows = list(held.items())
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.binary()), pa.array([r[0] for _, r in rows], pa.int64()),
                                               pa.array([r[1] for _, r in rows], pa.int64())], names=["digest", "doc_id", "n"])
        for b in batches:
            for d, i, n in zip(*(c.to_pylist() for c in b.columns)):
                row = held.get(d)
                if row is None:
                    held[d] = [i, n]
                else:
                    row[1] += n
                    if row[0] is None or (i is not None and i < row[0]):
                        row[0] = i
            if len(held) >= COMBINED:
                yield out()
                held.clear()
        if held:
            yield out()
    return members.select("digest", "doc_id", "n").mapInArrow(run, "digest binary, doc_id long, n long")


def _apply(keys: DataFrame | None, change: DataFrame, buckets: int, deletes: bool) -> DataFrame:
    """The buckets' keys and filters after ``change`` (digest, doc_id, n)."""
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")
    none = F.lit(None)
    rows = change.select(bucket.alias("bucket"), "digest", F.col("doc_id").alias("keep_id"), "n", F.lit(2).alias("kind"),
                         none.cast("int").alias("cells"), none.cast("binary").alias("held"))
    if keys is not None:        # a bucket's filter comes first, then its keys, then what is new
        kind = F.when(F.col("held").isNotNull(), 0).otherwise(1)
        rows = rows.unionByName(keys.select("bucket", "digest", "keep_id", "n", kind.alias("kind"), "cells", "held"))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "kind").select("bucket", "digest", "keep_id", "n", "kind", "cells", "held")

    def run(batches):
        now, state = None, None

        def out():
            ks = list(state.keys.items())
            m = len(ks)
            cols = [pa.array([now] * (m + 1), pa.int32()), pa.array([d for d, _ in ks] + [None], pa.binary()), pa.array([r[0] for _, r in ks] + [None], pa.int64()),
                    pa.array([r[1] for _, r in ks] + [None], pa.int64()), pa.array([r[2] for _, r in ks] + [None], pa.bool_()),
                    pa.array([None] * m + [state.filter.log2], pa.int32()), pa.array([None] * m + [state.filter.held.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["bucket", "digest", "keep_id", "n", "stale", "cells", "held"])
        for b in batches:
            for at, digest, doc_id, n, kind, cells, held in zip(*(c.to_pylist() for c in b.columns)):
                if at != now:
                    if state is not None:
                        yield out()
                    now, state = at, Bucket(cells, held) if kind == 0 else Bucket()
                if kind == 1:
                    state.keys[digest] = [doc_id, n, False]
                elif kind == 2 and deletes:
                    state.delete(digest, doc_id, n)
                elif kind == 2:
                    state.insert(digest, doc_id, n)
        if state is not None:
            yield out()
    return dealt.mapInArrow(run, KEYS)


def _members(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def build(docs: DataFrame, digest_of: Callable[[Column], Column] = sha256, buckets: int | None = None) -> Index:
    """An index of all rows of ``docs``."""
    ship_package(docs.sparkSession)
    members = cut(_members(_rows(docs, digest_of)), "exact-members")
    if buckets is None:
        buckets = max(LEAST_BUCKETS, -(-members.count() // KEYS_PER_BUCKET))
    keys = cut(_apply(None, _combined(members), buckets, False), "exact-keys")
    return Index(keys, members, docs.select("doc_id", "text"), buckets, digest_of)


def insert(index: Index, docs: DataFrame) -> Index:
    """``index`` with the rows of ``docs`` added."""
    new = cut(_members(_rows(docs, index.digest_of)), "exact-members")
    keys = cut(_apply(index.keys, _combined(new), index.buckets, False), "exact-keys")
    members = index.members.unionByName(new).groupBy("digest", "doc_id").agg(F.sum("n").alias("n"))
    return Index(keys, cut(members, "exact-members"), index.docs.unionByName(docs.select("doc_id", "text")), index.buckets, index.digest_of)


def delete(index: Index, docs: DataFrame) -> Index:
    """``index`` without the rows of ``docs``: as many rows of the same id and
    text go as ``docs`` holds; rows that the index lacks are ignored."""
    gone = _members(_rows(docs, index.digest_of)).withColumnRenamed("n", "out")
    same = (F.col("m.digest") == F.col("g.digest")) & F.col("m.doc_id").eqNullSafe(F.col("g.doc_id"))
    left = cut(index.members.alias("m").join(gone.alias("g"), same, "left")
               .select("m.digest", "m.doc_id", "m.n", F.least("m.n", F.coalesce("g.out", F.lit(0))).alias("out")), "exact-members")
    change = left.where("out > 0").select("digest", "doc_id", F.col("out").alias("n"))
    members = left.where("n > out").select("digest", "doc_id", (F.col("n") - F.col("out")).alias("n"))
    keys = cut(_apply(index.keys, change, index.buckets, True), "exact-keys")
    # keys whose keeper went take the smallest id that is left
    least = (members.join(keys.where("stale").select("digest"), "digest", "left_semi")
             .groupBy("digest").agg(F.min("doc_id").alias("least")))
    keys = (keys.join(least, "digest", "left")
            .select("bucket", "digest", F.when(F.col("stale"), F.col("least")).otherwise(F.col("keep_id")).alias("keep_id"), "n",
                    F.when(F.col("digest").isNotNull(), F.lit(False)).alias("stale"), "cells", "held"))
    return Index(cut(keys, "exact-keys"), members, index.docs, index.buckets, index.digest_of)


def _live(index: Index, digests: DataFrame) -> DataFrame:
    """Live rows of ``digests`` with their normalised texts, one for each id
    and text, ``n`` times held.  A sieve keeps other texts out of the shuffle."""
    rows = _rows(index.docs, index.digest_of)
    bits = Sieve(digests, "digest").bits
    slot = F.pmod(F.xxhash64("digest"), F.lit(Sieve.SLOTS))

    @F.pandas_udf("boolean")
    def known(at):
        import numpy as np
        import pandas as pd
        a = at.to_numpy().astype(np.int64)
        return pd.Series((bits.value[a >> 6] >> (a & 63).astype(np.uint64)) & np.uint64(1) == 1)
    return rows.where(known(slot))


def verified(index: Index) -> tuple[DataFrame, DataFrame]:
    """Digests with more than one live row, by content: (digest, keep_id, n)
    where all contents are equal, and (digest, text) with their own keep_id
    and n where a digest stands for unequal texts."""
    several = index.keys.where("n > 1").select("bucket", "digest", "keep_id", "n")
    content = (_live(index, several).groupBy("digest", "text").agg(F.count(F.lit(1)).alias("held"))
               .groupBy("digest").agg(F.count(F.lit(1)).alias("texts")))
    checked = cut(several.join(content, "digest"), "exact-checked")
    return checked.where("texts = 1").select("digest", "keep_id", "n"), checked.where("texts > 1").select("digest")


def resolve(index: Index) -> DataFrame:
    """One row per live row: doc_id, digest, keep_id, group_size, kept."""
    groups, unequal = verified(index)
    odd = unequal.limit(1).count() > 0
    members = index.members
    if odd:
        members = members.join(unequal, "digest", "left_anti")
    one = F.col("g.n").isNull()
    out = (members.alias("m").join(groups.select(F.col("digest").alias("_d"), "keep_id", "n").alias("g"), F.col("m.digest") == F.col("g._d"), "left")
           .select("m.doc_id", "m.digest", F.when(one, F.col("m.doc_id")).otherwise(F.col("g.keep_id")).alias("keep_id"),
                   F.coalesce("g.n", F.lit(1)).cast("long").alias("group_size"), F.col("m.n").alias("n")))
    if odd:      # a digest of unequal texts: its rows are grouped by the text itself
        same = (F.col("a.digest") == F.col("b.digest")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        rows = _live(index, unequal).join(unequal, "digest", "left_semi").groupBy("digest", "doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
        # deleted rows are still among the documents; members hold what is live
        rows = rows.alias("a").join(index.members.alias("b"), same, "left_semi")
        by_text = rows.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        out = out.unionByName(rows.join(by_text, ["digest", "text"]).select("doc_id", "digest", "keep_id", "group_size", "n"))
    return (out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"), "digest"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the least
    id, with all its columns; null ids sort last."""
    names = docs.columns
    text = F.col("`text`").cast("string") if "text" in names else F.lit(None)
    w = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.col("`doc_id`").cast("long").alias("id"),
                    sha256(normalised(F.coalesce(text, F.lit("")))).alias("digest"))
    keep = resolve(build(docs)).where("kept").select(F.col("keep_id").alias("id"), "digest")
    same = (F.col("w.digest") == F.col("k.digest")) & F.col("w.id").eqNullSafe(F.col("k.id"))
    # rows that repeat an id and a text: any one of them
    return (w.alias("w").join(keep.alias("k"), same, "left_semi").groupBy("id", "digest").agg(F.any_value("row").alias("row"))
            .select("row.*"))


def digest(docs: DataFrame) -> DataFrame:
    return resolve(build(docs)).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


DIGEST_SQL = r"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d
"""
