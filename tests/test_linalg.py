"""Block matrix product and truncated SVD."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.operators import linalg as L


def coo(spark, x, kind="double"):
    cast = int if kind == "bigint" else float
    rows = [(int(i), int(j), cast(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame(rows, f"i bigint, j bigint, v {kind}")


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.i, r.j] = r.v
    return out


@pytest.mark.parametrize("size", [1, 3, 8, 64])
def test_blocks_multiply_like_numpy(spark, size):
    rng = np.random.default_rng(size)
    x, y = (np.where(rng.random(s) < 0.3, rng.integers(-9, 9, s), 0) for s in ((17, 23), (23, 11)))
    got = L.matmul_coo(coo(spark, x, "bigint"), coo(spark, y, "bigint"), size)
    assert got.schema["v"].dataType.typeName() == "long"
    assert (dense(got, (17, 11)) == x @ y).all()


def test_cells_are_those_of_the_join(spark):
    """A cell whose products cancel is there, one that no pair meets in is not;
    repeated entries add up and NULLs are no entries."""
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.0), (2, 5, 7.0), (1, 1, 2.0), (1, 1, 3.0), (None, 0, 1.0), (3, 0, None)], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(0, 0, 4.0), (1, 0, -4.0), (1, None, 2.0)], "i bigint, j bigint, v double")
    assert sorted(map(tuple, L.matmul_coo(a, b, 2).collect())) == [(0, 0, 0.0), (1, 0, -20.0)]
    assert L.matmul_coo(a, b.where("false"), 2).collect() == []


def test_a_dense_inner_index_spreads_over_all_tasks(spark):
    """One inner index meets 512 rows and 512 columns: a join on it alone is
    one task; blocks of 32 make 256 pairs."""
    n = 512
    a = spark.range(n).select(F.col("id").alias("i"), F.lit(7).cast("bigint").alias("j"), (F.col("id") + 1).alias("v"))
    b = spark.range(n).select(F.lit(7).cast("bigint").alias("i"), F.col("id").alias("j"), (F.col("id") + 2).alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1")):
            spark.conf.set(k, v)
        pairs = L.block_pairs(L.to_blocks(a, 32), L.to_blocks(b, 32))
        per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(per_task) == 256 and len(per_task) == 8 and max(per_task) < 64
        assert max(len(r.ix) for r in L.to_blocks(a, 32).collect()) == 32
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert L.matmul_coo(a, b, 32).where("v <> (i + 1) * (j + 2)").count() == 0
    assert L.matmul_coo(a, b, 32).count() == n * n


def vectors(spark, x, parts=7):
    return spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(parts)


@pytest.mark.parametrize("rows,parts", [(300, 1), (300, 23), (5, 9), (9, 2)])
def test_singular_pairs_equal_numpy(spark, rows, parts):
    x = np.random.default_rng(rows).normal(size=(rows, 8)) * np.logspace(0, -3, 8)
    got = L.singular_pairs(vectors(spark, x, parts), "x", 6).orderBy("k").collect()
    _, s, vt = np.linalg.svd(x)
    full = np.concatenate((s, np.zeros(8)))[:6]
    assert np.allclose([r.sigma for r in got], full, atol=1e-12)
    for r, want in zip(got, vt):
        if full[r.k] > 1e-9:
            assert np.isclose(abs(np.dot(r.v, want)), 1.0)


def test_small_singular_values_keep_their_digits(spark):
    """The Gram matrix squares the condition: 1e-9 drowns in it, not here."""
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(200, 4)))
    x = q * np.array([1.0, 1e-3, 1e-6, 1e-9])
    got = [r.sigma for r in L.singular_pairs(vectors(spark, x), "x", 4).orderBy("k").collect()]
    assert np.allclose(got, [1.0, 1e-3, 1e-6, 1e-9], rtol=1e-5)


def test_residuals_tell_wrong_pairs(spark):
    x = np.random.default_rng(4).normal(size=(100, 6))
    df = vectors(spark, x)
    pairs, gram = L.singular_pairs(df, "x", 3), L.gram_matrix(df, "x")
    assert all(r.residual < 1e-12 for r in L.pair_residuals(pairs, gram).collect())
    wrong = pairs.withColumn("v", F.reverse("v"))
    assert all(r.residual > 1e-3 for r in L.pair_residuals(wrong, gram).collect())


def test_vectors_that_cannot_be_factored_fail(spark):
    with pytest.raises(Exception, match="at most 3"):
        L.singular_pairs(vectors(spark, np.ones((4, 8))), "x", 2, max_columns=3).collect()
    with pytest.raises(Exception, match="one length"):
        L.singular_pairs(spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "x array<double>").coalesce(1), "x", 1).collect()
    nulls = spark.createDataFrame([(None,), ([3.0, 4.0],)], "x array<double>")
    assert [round(r.sigma, 9) for r in L.singular_pairs(nulls, "x", 1).collect()] == [5.0]
    assert L.singular_pairs(nulls.where("false"), "x", 1).collect() == []
