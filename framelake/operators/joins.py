"""Joining a small per-video / per-chunk table onto frame rows.

Frame rows can carry megabytes of pixels.  With a sort-merge join the frame
side would be shuffled (AQE can only switch to a broadcast *after* both map
stages ran), so small sides are joined through :func:`join_small`: the small
side is materialised once in the shared checkpoint folder (cutting its
lineage — e.g. a detection is never recomputed), its row count is checked,
and it is broadcast only below ``max_rows``; above that the join falls back
to a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.session import shared_dir

# One row per video or chunk is a few dozen bytes: a million rows stays far
# below executor memory when broadcast.
BROADCAST_MAX_ROWS = 1_000_000


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS, prune: str | None = None, null_keys: bool | Sequence[str] = False) -> DataFrame:
    """``null_keys``: NULL is a key like any other, in all columns of ``on`` or
    in those named.  ``prune`` names a column of ``on`` without NULLs in ``small``: a filter
    on its least value, which keeps every row, makes Spark take the small side
    as selective and prune the partitions of ``big`` by the join keys."""
    shared_dir(small.sparkSession)
    s = small.checkpoint(eager=True)
    n, low = s.agg(F.count(F.lit(1)), F.min(prune) if prune else F.lit(None)).first()
    if low is not None:
        s = s.where(F.col(prune) >= F.lit(low))
    if null_keys:
        return by_keys(big, s, [on] if isinstance(on, str) else on, how, "broadcast" if n <= max_rows else None,
                       None if null_keys is True else null_keys)
    return big.join(F.broadcast(s) if n <= max_rows else s, on if isinstance(on, str) else list(on), how)


def by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hint: str | None = None,
            null_keys: Sequence[str] | None = None) -> DataFrame:
    """``left`` joined with ``right`` on ``keys`` as values, NULL keys
    included (a plain equi-join loses them), in all columns or in
    ``null_keys``; the keys come from ``left``."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on: Column = F.lit(True)
    for k in keys:
        right_key = F.col(f"_r_{k}")
        on = on & (F.col(k).eqNullSafe(right_key) if null_keys is None or k in null_keys else F.col(k) == right_key)
    return left.join(r.hint(hint) if hint else r, on, how).drop(*[f"_r_{k}" for k in keys])
