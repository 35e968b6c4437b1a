"""Document fingerprints (operator 7), DataFrame operations only.

SimHash of 128 bits: every word votes with its weight on each bit of its two
64-bit hashes, and the sign of the sum is the bit of the fingerprint.  Votes
are counted two bits at a time in the halves of long sums, so Spark's hash
aggregation adds 64 sums a word without a row for each bit.  Words longer than
three letters weigh more, as short ones are mostly the same in all texts.

:func:`near` finds all pairs of fingerprints within a Hamming radius: the bits
are cut into ``radius + 2`` blocks, and for every choice of two blocks a table
is keyed by those blocks.  Fingerprints that differ in at most ``radius`` bits
agree on two blocks at least, so they meet in one of the tables; a pair counts
in the first table it meets in, so none has to be told from its repeats.
:func:`search` counts rows within the radius of given fingerprints; rows of
equal fingerprints are one entry with their number.  The query asks it for the
rows whose id is divisible by ``QUERY_EVERY``, against all rows: ``n_near`` is the
number of other rows within ``RADIUS`` bits, ``first_near`` the least id within
them, its own included (null for the rows not asked for).

Null and empty texts have the fingerprint of no votes, all zeros.  Equal texts
have equal fingerprints.  Rows follow each other by id, nulls first, and rows
of one id by their text's hash; every row of a repeated document is returned.
An empty table gives no rows, a single row is its own next one.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import cut, keyed

BITS = 128
BLOCK_ROWS = 512            # rows of one step of the search for next rows
LAST_ROWS = 4096            # groups that one window may order
CELLS = 64                  # quantiles of the ids
RADIUS = 3                  # bits that near fingerprints may differ in
QUERY_EVERY = 20            # the query searches for the ids divisible by this
_PAIR = 0x0000000100000001  # the lowest bit of either half of a long


def fingerprints(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key`` and the fingerprint's halves ``f0``, ``f1`` of each key's text.
    Rows of an equal key vote together."""
    word = F.explode(F.split(F.translate(F.lower(text), "\n\t\r\f\v", "     "), " "))
    words = rows.select(*key, word.alias("w"))
    n = F.octet_length("w")
    voted = words.select(*key, F.when(n == 0, 0).when(n <= 3, 1).otherwise(4).cast("long").alias("v"),
                         F.xxhash64("w").alias("h0"), F.xxhash64("w", F.lit(1)).alias("h1"))
    sums = voted.groupBy(*key).agg(F.sum("v").alias("n"), *[
        F.sum(F.shiftrightunsigned(f"h{k}", j).bitwiseAND(F.lit(_PAIR)) * F.col("v")).alias(f"s{k}_{j}") for k in (0, 1) for j in range(32)])

    def half(k: int) -> Column:
        out = F.lit(0).cast("long")
        for j in range(32):
            low, high = F.col(f"s{k}_{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{k}_{j}", 32)
            for bit, votes in ((j, low), (j + 32, high)):
                out = out.bitwiseOR(F.shiftleft((votes * 2 > F.col("n")).cast("long"), bit))
        return out
    return sums.select(*key, half(0).alias("f0"), half(1).alias("f1"))


def hexadecimal(f0: str, f1: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits."""
    differing = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)), F.lit(0))
    return (1 - differing / F.lit(BITS)).cast("double")


def with_next(rows: DataFrame, group: str, order: list[str], payload: list[str], groups: int) -> DataFrame:
    """``rows`` with ``n_<payload>`` of the row that follows within the whole
    table (after the last: the first).  ``group`` numbers runs of rows in
    order; there are about ``groups`` of them.  Only the first row of every
    run takes part in the next, coarser step, so no task sees all rows."""
    item = F.struct(*payload)
    by = Window.partitionBy(group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    if groups <= 1:
        whole = Window.partitionBy(group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = rows.withColumn("_next", F.coalesce(F.lead(item).over(by), F.first(item).over(whole)))
        return out.select(*rows.columns, *[F.col(f"_next.{c}").alias(f"n_{c}") for c in payload])
    runs = rows.withColumn("_next", F.lead(item).over(by)).withColumn("rn", F.row_number().over(by))
    # the number is all the order that heads need; in a coarser step ``order`` is itself called _run
    heads = runs.where("rn = 1").select(F.col(group).alias("_run"), *payload)
    coarse = F.floor(F.col("_run") / BLOCK_ROWS).cast("long") if groups > LAST_ROWS else F.lit(0).cast("long")
    following = with_next(heads.withColumn("_g", coarse), "_g", ["_run"], payload, -(-groups // BLOCK_ROWS) if groups > LAST_ROWS else 1)
    following = following.select(F.col("_run").alias("_of"), F.struct(*[F.col(f"n_{c}").alias(c) for c in payload]).alias("_head"))
    out = runs.join(following, F.col(group) == F.col("_of"))
    out = out.withColumn("_next", F.coalesce("_next", "_head"))
    return out.select(*rows.columns, "rn", *[F.col(f"_next.{c}").alias(f"n_{c}") for c in payload])


def _runs(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number ``run`` of their run in order, and how many runs
    there may be.  Ids are cut at ``CELLS`` quantiles and evenly between two of
    them, so ids far from all others widen one cell only.  Rows without an id
    come first, in runs by their text's hash, which is their order."""
    levels = [k / CELLS for k in range(CELLS + 1)]
    seen = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("known"), F.percentile_approx("doc_id", levels, 100 * CELLS).alias("at")).first()
    at = sorted({int(v) for v in seen["at"] or [0]})           # at most CELLS + 1 ids
    nulls = max(1, -(-(int(seen["n"]) - int(seen["known"])) // BLOCK_ROWS))
    each = max(1, -(-int(seen["known"]) // (BLOCK_ROWS * len(at))))
    starts = F.lit(at)
    cell = F.greatest(F.size(F.filter(starts, lambda q: q <= F.col("doc_id"))), F.lit(1))
    low, high = F.element_at(starts, cell), F.try_element_at(starts, cell + 1)
    share = F.least(F.greatest((F.col("doc_id") - low) / F.greatest(F.coalesce(high, low + 1) - low, F.lit(1)), F.lit(0.0)), F.lit(1.0))
    by_id = nulls + (cell - 1) * each + F.least(F.floor(share * each), F.lit(each - 1))
    by_hash = F.least(F.floor((F.col("h") / F.lit(2.0 ** 64) + 0.5) * nulls), F.lit(nulls - 1))
    return rows.withColumn("run", F.when(F.col("doc_id").isNull(), by_hash).otherwise(by_id).cast("long")), nulls + each * len(at)


def digest(docs: DataFrame) -> DataFrame:
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
    rows, groups = _runs(rows)
    met = with_next(rows, "run", ["doc_id", "h"], ["doc_id", "h", "text"], groups)
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.expr("substring(n_text, 1, cast(floor(length(text) / 2) as int))"))
    key = ["run", "rn"]
    both = met.select(*key, F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), edited.alias("text")))))
    prints = fingerprints(both, [*key, "kind"], "text")
    pair = prints.groupBy(*key).agg(*[F.max(F.when(F.col("kind") == k, F.col(f"f{j}"))).alias(f"{name}{j}") for k, name in ((0, "f"), (1, "e")) for j in (0, 1)])
    facts = met.select(*key, "doc_id", "h", "n_doc_id", "n_h", n.cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"))
    # written: a row's fingerprint is read twice, and the words vote once
    printed = out = cut(facts.join(pair, key), "simhash-prints")
    # the next row's fingerprint is that of its id and text
    known = out.groupBy(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h")).agg(F.min("f0").alias("k0"), F.min("f1").alias("k1"))
    out = out.join(known, F.col("n_doc_id").eqNullSafe(F.col("k_id")) & (F.col("n_h") == F.col("k_h")))
    asked = F.pmod("doc_id", F.lit(QUERY_EVERY)) == 0
    found = search(printed.select("doc_id", "f0", "f1"), printed.where(asked))
    out = out.join(found, (F.col("f0") == F.col("a0")) & (F.col("f1") == F.col("a1")), "left")
    return out.select("doc_id", "n_chars", "edited_sha256", hexadecimal("f0", "f1").alias("fingerprint"), hexadecimal("e0", "e1").alias("edited_fingerprint"),
                      likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"), likeness(("f0", "f1"), ("k0", "k1")).alias("near_next"),
                      F.when(asked, F.col("n_rows") - 1).alias("n_near"), F.when(asked, F.col("first_id")).alias("first_near"))


def blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each of ``radius + 2`` blocks of the bits."""
    n = radius + 2
    edges = [k * BITS // n for k in range(n + 1)]
    return [(a, z - a) for a, z in zip(edges, edges[1:])]


def _bits(f0: str, f1: str, start: int, width: int) -> Column:
    """Bits of the pair of longs, up to 63, as a long."""
    out = F.lit(0).cast("long")
    for col, at in ((f0, 0), (f1, 64)):
        lo, hi = max(start, at), min(start + width, at + 64)
        if lo < hi:
            part = F.shiftrightunsigned(col, lo - at).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
            out = out.bitwiseOR(F.shiftleft(part, lo - start))
    return out


def _meet(prints: DataFrame, queries: DataFrame, radius: int, payload: list[str]) -> DataFrame:
    """a0, a1, b0, b1, distance and ``payload`` of b, once for each pair of a
    query's fingerprint a and a fingerprint b within ``radius`` bits.  Both
    inputs hold a fingerprint f0, f1 once."""
    cut_at = blocks(radius)
    choices = list(combinations(range(len(cut_at)), 2))

    def tables(df: DataFrame, a: str, more: list[str]) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("t"), _bits("f0", "f1", *cut_at[i]).alias("k0"), _bits("f0", "f1", *cut_at[j]).alias("k1"))
                         for t, (i, j) in enumerate(choices)])
        return df.select(F.col("f0").alias(f"{a}0"), F.col("f1").alias(f"{a}1"), *more, F.inline(keys))
    met = tables(queries, "a", []).join(tables(prints, "b", payload), ["t", "k0", "k1"])
    met = met.withColumn("x0", F.col("a0").bitwiseXOR(F.col("b0"))).withColumn("x1", F.col("a1").bitwiseXOR(F.col("b1")))
    met = met.withColumn("distance", F.bit_count("x0") + F.bit_count("x1")).where(F.col("distance") <= radius)
    equal = [_bits("x0", "x1", *c) == 0 for c in cut_at]
    first = F.coalesce(*[F.when(equal[i] & equal[j], F.lit(t)) for t, (i, j) in enumerate(choices)])
    return met.where(F.col("t") == first).select("a0", "a1", "b0", "b1", "distance", *payload)


def near(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a0, a1, b0, b1, distance): all pairs of a query's fingerprint a and a
    different fingerprint b within ``radius`` bits.  Both inputs have columns
    f0, f1; equal fingerprints are one.  ``radius`` may be 1 to 61."""
    return _meet(prints.select("f0", "f1").distinct(), queries.select("f0", "f1").distinct(), radius, []).where("distance > 0")


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a0, a1, n_rows, first_id): for each different fingerprint of ``queries``
    (f0, f1) the number and the least ``doc_id`` of the rows of ``prints``
    (doc_id, f0, f1) within ``radius`` bits, equal ones included."""
    known = prints.groupBy("f0", "f1").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    met = _meet(known, queries.select("f0", "f1").distinct(), radius, ["n", "least"])
    return met.groupBy("a0", "a1").agg(F.sum("n").alias("n_rows"), F.min("least").alias("first_id"))
