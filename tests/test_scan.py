"""Blocked ordered scans equal plain per-key windows, including a hot key
holding a third of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake.functions.scalars import idiv
from framelake.operators import scan


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 20)        # key 0 holds a third
        v = rnd.randint(0, 50) if rnd.random() < 0.3 else None
        rows.append((key, rnd.randint(0, 100000), i, v))
    return spark.createDataFrame(rows, "k int, t long, id int, v int")


def _cmp(a, b, cols):
    return sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_ordered_index(data):
    got = scan.ordered_index(data, ["k"], ["t", "id"], idiv(F.col("t"), F.lit(1000)))
    want = data.withColumn("ix", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert _cmp(got, want, ["k", "id", "ix"])


def test_running_max(data):
    got = scan.running_max(data, ["k"], ["t", "id"], idiv(F.col("t"), F.lit(997)), F.col("v"), "m")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumn("m", F.max("v").over(w))
    assert _cmp(got, want, ["k", "id", "m"])


def test_fill_forward(data):
    got = scan.fill_forward(data, ["k"], ["t", "id"], idiv(F.col("t"), F.lit(500)), F.col("v"), "f")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumn("f", F.last("v", ignorenulls=True).over(w))
    assert _cmp(got, want, ["k", "id", "f"])


def test_previous_and_next(data):
    w = Window.partitionBy("k").orderBy("t", "id")
    blk = idiv(F.col("t"), F.lit(3000))
    got = scan.previous_value(data, ["k"], ["t", "id"], blk, F.col("id"), "p")
    assert _cmp(got, data.withColumn("p", F.lag("id").over(w)), ["k", "id", "p"])
    got = scan.next_value(data, ["k"], ["t", "id"], blk, F.col("id"), "n")
    assert _cmp(got, data.withColumn("n", F.lead("id").over(w)), ["k", "id", "n"])


def test_result_invariant_to_partition_count(spark, data):
    a = scan.ordered_index(data.repartition(1), ["k"], ["t", "id"], idiv(F.col("t"), F.lit(1000)))
    b = scan.ordered_index(data.repartition(13), ["k"], ["t", "id"], idiv(F.col("t"), F.lit(1000)))
    assert _cmp(a, b, ["k", "id", "ix"])


def test_null_keys_orders_and_values(spark):
    """NULL keys, order values and values behave as in a plain window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from framelake.operators import scan as SC
    rows = [(k, None if i % 11 == 5 else i * 7 % 40, i, None if i % 3 == 0 else i) for i, k in enumerate([1, None, 2, None, 1, 1, None] * 9)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v int")
    order, blk = ["t", "id"], F.floor(F.col("t") / 8)
    w = Window.partitionBy("k").orderBy(*order)
    want = (df.withColumn("ix", F.row_number().over(w).cast("bigint")).withColumn("prev", F.lag("v").over(w)).withColumn("next", F.lead("v").over(w))
            .withColumn("top", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("last", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    got = SC.ordered_index(df, ["k"], order, blk, "ix")
    got = SC.previous_value(got, ["k"], order, blk, F.col("v"), "prev")
    got = SC.next_value(got, ["k"], order, blk, F.col("v"), "next")
    got = SC.running_max(got, ["k"], order, blk, F.col("v"), "top")
    got = SC.fill_forward(got, ["k"], order, blk, F.col("v"), "last").select(want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
