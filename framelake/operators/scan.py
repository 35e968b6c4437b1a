"""Ordered scans that do not collapse a key into one task.

A window ``partitionBy(video).orderBy(pts)`` sends every frame of a video to
a single task; one long recording can hold a third of all rows, so that task
would sort a third of the data.  These helpers split each key into *blocks*
(a monotone function of the order column, e.g. ``pts_us div 60 s``), run the
window per ``(key, block)`` — many bounded tasks — and carry state across
blocks through a per-block summary that has one row per block (small: it is
aggregated map-side before the shuffle).  The block summary is joined back;
AQE turns that join into a broadcast once it has measured the summary.

The block expression must be non-decreasing in the order, so that every row
of block ``b`` sorts before every row of block ``b + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLK = "_blk"


def _with_block(df: DataFrame, block: Column) -> DataFrame:
    return df.withColumn(BLK, block)


def _prev_blocks(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)


def _attach(d: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``d`` with the columns of its block's summary row.  NULL keys and NULL
    blocks (a NULL order column; sorts first) are values like any other, as
    in a window."""
    on = [*keys, BLK]
    s = summary.select(*[F.col(c).alias(f"_s_{c}") for c in on], *[c for c in summary.columns if c not in on])
    cond = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in on]
    return d.join(s, cond, "left").drop(*[f"_s_{c}" for c in on])


def ordered_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  block: Column, name: str = "ix") -> DataFrame:
    """Add ``name`` = 1-based position of each row within ``keys`` in ``order``.

    Equivalent to ``row_number() over (partition by keys order by order)``.
    """
    d = _with_block(df, block)
    counts = d.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(*keys, BLK, F.coalesce(F.sum("_n").over(_prev_blocks(keys)), F.lit(0))
                         .cast("bigint").alias("_off"))
    local = Window.partitionBy(*keys, BLK).orderBy(*order)
    d = d.withColumn("_l", F.row_number().over(local))
    return (_attach(d, offs, keys)
             .withColumn(name, (F.col("_off") + F.col("_l")).cast("bigint"))
             .drop(BLK, "_off", "_l"))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                block: Column, value: Column, name: str) -> DataFrame:
    """Add ``name`` = max of ``value`` over all rows up to and including this
    one (NULLs ignored), per ``keys`` in ``order``."""
    d = _with_block(df, block).withColumn("_v", value)
    per_blk = d.groupBy(*keys, BLK).agg(F.max("_v").alias("_bm"))
    carry = per_blk.select(*keys, BLK, F.max("_bm").over(_prev_blocks(keys)).alias("_carry"))
    local = Window.partitionBy(*keys, BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_l", F.max("_v").over(local))
    return (_attach(d, carry, keys)
             .withColumn(name, F.greatest(F.col("_carry"), F.col("_l")))
             .drop(BLK, "_v", "_carry", "_l"))


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 block: Column, value: Column, name: str) -> DataFrame:
    """Add ``name`` = the last non-NULL ``value`` at or before each row
    (``last(value, ignoreNulls)`` over an unbounded-preceding frame)."""
    d = _with_block(df, block).withColumn("_v", value)
    ord_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    # max_by skips rows whose ordering is NULL: the block's last non-NULL value.
    per_blk = d.groupBy(*keys, BLK).agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), ord_struct)).alias("_bl"))
    carry = per_blk.select(*keys, BLK, F.last("_bl", ignorenulls=True)
                           .over(_prev_blocks(keys)).alias("_carry"))
    local = Window.partitionBy(*keys, BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_l", F.last("_v", ignorenulls=True).over(local))
    return (_attach(d, carry, keys)
             .withColumn(name, F.coalesce("_l", "_carry"))
             .drop(BLK, "_v", "_carry", "_l"))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   block: Column, value: Column, name: str) -> DataFrame:
    """Add ``name`` = ``value`` of the previous row in ``order`` (``lag 1``)."""
    d = _with_block(df, block).withColumn("_v", value)
    ord_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    per_blk = d.groupBy(*keys, BLK).agg(F.max_by("_v", ord_struct).alias("_bl"))
    carry = per_blk.select(*keys, BLK, F.lag("_bl").over(Window.partitionBy(*keys).orderBy(BLK))
                           .alias("_carry"))
    local = Window.partitionBy(*keys, BLK).orderBy(*order)
    d = d.withColumn("_l", F.lag("_v").over(local)).withColumn("_edge", F.row_number().over(local) == 1)
    return (_attach(d, carry, keys)
             .withColumn(name, F.when(F.col("_edge"), F.col("_carry")).otherwise(F.col("_l")))
             .drop(BLK, "_v", "_carry", "_l", "_edge"))


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
               block: Column, value: Column, name: str) -> DataFrame:
    """Add ``name`` = ``value`` of the next row in ``order`` (``lead 1``)."""
    d = _with_block(df, block).withColumn("_v", value)
    ord_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    per_blk = d.groupBy(*keys, BLK).agg(F.min_by("_v", ord_struct).alias("_bf"))
    carry = per_blk.select(*keys, BLK, F.lead("_bf").over(Window.partitionBy(*keys).orderBy(BLK))
                           .alias("_carry"))
    local = Window.partitionBy(*keys, BLK).orderBy(*order)
    # the last row of a block takes the next block's value, also where the next value is NULL
    d = d.withColumn("_l", F.lead("_v").over(local)).withColumn("_edge", F.lead(F.lit(True)).over(local).isNull())
    return (_attach(d, carry, keys)
             .withColumn(name, F.when(F.col("_edge"), F.col("_carry")).otherwise(F.col("_l")))
             .drop(BLK, "_v", "_carry", "_l", "_edge"))
