"""Error policy — split rows into good and quarantined without failing
the job (the per-row error is a column, not an exception)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_valid(df: DataFrame, error: Column, error_name: str = "error") -> tuple[DataFrame, DataFrame]:
    """Return ``(good, quarantine)``: quarantine rows carry the error text."""
    tagged = df.withColumn(error_name, error)
    good = tagged.where(F.col(error_name).isNull()).drop(error_name)
    bad = tagged.where(F.col(error_name).isNotNull())
    return good, bad
