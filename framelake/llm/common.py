"""Shared helpers of the text operators: inputs, lineage cuts, Arrow maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.session import shared_dir, ship_package

BATCH_ROWS = 1000      # rows of an Arrow batch: whole texts, so a batch of Spark's 10,000 is large


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the cluster's shared folder and read it
    back: later jobs start from files that survive a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null text: empty) and no other column, so that
    names of extra columns never clash with an operator's own."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def arrow_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches small enough for whole texts."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def arrow_map(df: DataFrame, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None],
              schema: str | T.StructType) -> DataFrame:
    """:func:`arrow_rows` with a function of one batch."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                out = make(b)
                if out is None:
                    continue
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
        pa.default_memory_pool().release_unused()
    return arrow_rows(df, run, schema)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``: the contracts' split of rows.
    Null ids get 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")


def columns_of(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


class Sieve:
    """A bitmap of fixed size (4 MB) of key hashes, for taking rows that can
    have a partner out of a wide table before it is shuffled.  It only ever
    passes too many rows; the join that follows is exact."""

    SLOTS = 1 << 25

    def __init__(self, keys: DataFrame, *columns: str, hashed: bool = False):
        """``hashed``: the one column is a hash already and its low bits are
        the slot."""
        self.columns, self.hashed = columns, hashed
        slot = self._slot()
        rows = (keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toPandas())
        bits = np.zeros(self.SLOTS >> 6, np.int64)
        bits[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
        self.bits = keys.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def _slot(self) -> Column:
        if self.hashed:
            return F.col(self.columns[0]).bitwiseAND(F.lit(self.SLOTS - 1))
        return F.pmod(F.xxhash64(*self.columns), F.lit(self.SLOTS))

    @staticmethod
    def hits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which hashes (uint64) may be known; ``bits`` is the broadcast value."""
        slot = hashes & np.uint64(Sieve.SLOTS - 1)
        return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    def take(self, df: DataFrame, passing: bool = True) -> DataFrame:
        """The rows of ``df`` whose key may be known, or all the others."""
        bits = self.bits

        def make(b: pa.RecordBatch):
            slot = b.column(b.num_columns - 1).to_numpy().astype(np.int64)
            hit = (bits.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            return b.select(b.schema.names[:-1]).filter(pa.array((hit == 1) == passing))
        return arrow_map(df.withColumn("_slot", self._slot()), make, df.schema)
