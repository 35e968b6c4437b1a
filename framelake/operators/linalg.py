"""L1/L2: matrix product over blocks and a truncated SVD.

Matrices come in coordinate form ``(i, j, v)`` or as one vector per row.
Nothing is collected: products meet block by block, and the SVD reduces
triangular factors in a tree of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.functions.scalars import idiv

BLOCK = 512             # rows and columns of a block: at most 256 Ki entries
MAX_COLUMNS = 2048      # of a matrix to be factored: a factor then takes 32 MB
FAN = 8                 # factors stacked in one reduction step


# ------------------------------------------------------------------ L1: product
def to_blocks(m: DataFrame, size: int = BLOCK) -> DataFrame:
    """``(i, j, v)`` as blocks ``(bi, bj, ix, jx, vs)``: block number and three
    arrays of the entries in it.  Entries that occur twice are added up, those
    with a NULL index or value are none.  A block holds ``size * size`` entries
    at most, however dense a row or a column of the matrix is."""
    n = F.lit(size).cast("bigint")
    e = (m.where("i IS NOT NULL AND j IS NOT NULL AND v IS NOT NULL")
          .groupBy(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j")).agg(F.sum("v").alias("v")))
    packed = (e.groupBy(idiv(F.col("i"), n).alias("bi"), idiv(F.col("j"), n).alias("bj"))
               .agg(F.collect_list(F.struct("i", "j", "v")).alias("_e")))
    return packed.select("bi", "bj", F.col("_e.i").alias("ix"), F.col("_e.j").alias("jx"), F.col("_e.v").alias("vs"))


def block_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Blocks that are multiplied: block ``(bi, bk)`` of A is replicated along
    the block columns ``bj`` that B has at ``bk``, block ``(bk, bj)`` of B
    along A's block rows, and both meet on all three numbers.  So the pairs of
    one inner index, dense as it may be, are spread over the whole grid."""
    rows = a.groupBy(F.col("bj").alias("bk")).agg(F.collect_set("bi").alias("_bis"))
    cols = b.groupBy(F.col("bi").alias("bk")).agg(F.collect_set("bj").alias("_bjs"))
    left = (a.withColumnRenamed("bj", "bk").join(cols, "bk")
             .select("bi", "bk", F.explode("_bjs").alias("bj"), F.col("ix").alias("ai"), F.col("jx").alias("aj"), F.col("vs").alias("av")))
    right = (b.withColumnRenamed("bi", "bk").join(rows, "bk")
              .select(F.explode("_bis").alias("bi"), "bk", "bj", F.col("ix").alias("ci"), F.col("jx").alias("cj"), F.col("vs").alias("cv")))
    return left.join(right, ["bi", "bk", "bj"])


def _multiply(ai, aj, av, ci, cj, cv):
    """Product of two blocks given by their entries: ``(i, j, v)`` of every
    cell that at least one pair of entries meets in."""
    import numpy as np
    inner, both = np.intersect1d(aj, ci), lambda x: np.unique(x, return_inverse=True)
    ka, kb = np.isin(aj, inner), np.isin(ci, inner)
    i, at_i = both(ai[ka])
    j, at_j = both(cj[kb])
    left, right = np.zeros((len(i), len(inner)), av.dtype), np.zeros((len(inner), len(j)), cv.dtype)
    met_l, met_r = np.zeros(left.shape, np.float32), np.zeros(right.shape, np.float32)
    at = np.searchsorted(inner, aj[ka])
    left[at_i, at], met_l[at_i, at] = av[ka], 1
    at = np.searchsorted(inner, ci[kb])
    right[at, at_j], met_r[at, at_j] = cv[kb], 1
    y, x = np.nonzero(met_l @ met_r)
    return i[y], j[x], (left @ right)[y, x]


def matmul_blocks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two block tables as ``(i, j, v)``: every task multiplies its
    pairs of blocks with numpy, and the partial products of a cell are added
    up, within a task first."""
    import numpy as np
    import pyarrow as pa

    from framelake.session import ship_package
    ship_package(a.sparkSession)
    # whole numbers stay whole; Spark adds BIGINT to BIGINT
    whole = all(d.schema["vs"].dataType.elementType.typeName() in ("long", "integer", "short", "byte") for d in (a, b))
    kind, dtype = ("bigint", np.int64) if whole else ("double", np.float64)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                ai, aj, av, ci, cj, cv = (batch.column(k)[r].values.to_numpy(zero_copy_only=False) for k in range(6))
                i, j, v = _multiply(ai, aj, av.astype(dtype), ci, cj, cv.astype(dtype))
                for lo in range(0, len(i), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + (1 << 16)]) for x in (i, j, v)], names=["i", "j", "v"])

    pairs = block_pairs(a, b).select("ai", "aj", "av", "ci", "cj", "cv")
    return pairs.mapInArrow(run, f"i bigint, j bigint, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v"))


def matmul_coo(a: DataFrame, b: DataFrame, size: int = BLOCK) -> DataFrame:
    """C = A x B for ``(i, j, v)`` tables, multiplied block by block."""
    return matmul_blocks(to_blocks(a, size), to_blocks(b, size))


# ---------------------------------------------------------------------- L2: SVD
def gram_matrix(rows: DataFrame, vector_col: str) -> DataFrame:
    """``G = X^T X`` of a tall matrix stored one vector per row.

    Every task multiplies its Arrow batches with numpy, adds them up and emits
    its partial d x d sums once as ``(i, j, g)`` rows; one aggregation adds the
    partials.  Only d^2 values leave a task, whatever the number of rows."""
    import numpy as np
    import pandas as pd

    from framelake.session import ship_package
    ship_package(rows.sparkSession)

    def run(batches):
        g = None
        for b in batches:
            if len(b):
                x = np.stack([np.asarray(v, dtype=np.float64) for v in b[vector_col]])
                g = x.T @ x if g is None else g + x.T @ x
        if g is not None:
            i, j = np.indices(g.shape)
            yield pd.DataFrame({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "g": g.ravel()})

    part = rows.select(vector_col).mapInPandas(run, "i int, j int, g double")
    return part.groupBy("i", "j").agg(F.sum("g").alias("g"))


_FACTOR = "part long, d int, r binary"


def triangular_factor(rows: DataFrame, vector_col: str, max_columns: int = MAX_COLUMNS, fan: int = FAN) -> DataFrame:
    """The R of X = QR for a tall matrix of one vector per row, as one row
    ``(part, d, r)`` with the d x d values in ``r``; no row without vectors.

    Every task folds its Arrow batches into one factor; then factors are
    stacked ``fan`` at a time and factored again, in a tree of tasks, until one
    is left.  X^T X is never formed, so small singular values keep their
    digits.  NULL vectors are left out; vectors of unequal length, with NULL
    entries or of more than ``max_columns`` fail."""
    import numpy as np
    import pyarrow as pa

    from framelake.session import scratch_path, ship_package
    spark = rows.sparkSession
    ship_package(spark)

    def folded(r, x):
        return np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")

    def emitted(part, r):
        full = np.zeros((r.shape[1], r.shape[1]))
        full[:len(r)] = r                                   # fewer rows than columns
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.shape[1]], pa.int32()), pa.array([full.tobytes()], pa.binary())], names=["part", "d", "r"])

    def leaves(batches):
        from pyspark import TaskContext
        r = None
        for b in batches:
            col = b.column(0)
            if not len(col):
                continue
            flat = col.flatten()
            d = len(flat) // len(col)
            if d > max_columns:
                raise ValueError(f"vectors of {d} values; at most {max_columns} can be factored")
            if flat.null_count or any(n != d for n in np.diff(col.offsets.to_numpy())) or (r is not None and r.shape[1] != d):
                raise ValueError("vectors must have one length and no NULL values")
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
            for lo in range(0, len(x), 4096):
                r = folded(r, x[lo:lo + 4096])
        if r is not None:
            yield emitted(TaskContext.get().partitionId(), r)

    def stacked(batches):
        now, r = None, None
        for b in batches:
            for part, d, raw in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(raw).reshape(d, d)
                if r is not None and now == part and r.shape[1] != d:
                    raise ValueError("vectors must have one length and no NULL values")
                if now != part and r is not None:
                    yield emitted(now, r)
                    r = None
                now, r = part, folded(r, x)
        if r is not None:
            yield emitted(now, r)

    path = scratch_path(spark, "factors")        # written: the data is read once
    rows.select(vector_col).where(F.col(vector_col).isNotNull()).mapInArrow(leaves, _FACTOR).write.parquet(path)
    out = spark.read.schema(_FACTOR).parquet(path)
    top = out.agg(F.max("part")).first()[0]
    while top:
        # factors of one number are stacked, so each step leaves an eighth
        out = (out.withColumn("part", idiv(F.col("part"), F.lit(fan).cast("bigint"))).repartition(max(1, -(-(top + 1) // fan)), "part")
                  .sortWithinPartitions("part").mapInArrow(stacked, _FACTOR))
        top //= fan
    return out


def singular_pairs(rows: DataFrame, vector_col: str, k: int, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Top-k singular values and right vectors ``(k, sigma, v)`` of a tall
    matrix, from its triangular factor, in the task that holds it.  The sign of
    a vector is that of its largest entry."""
    import numpy as np
    import pyarrow as pa

    def solve(batches):
        for b in batches:
            for d, raw in zip(b.column("d").to_pylist(), b.column("r").to_pylist()):
                _, s, vt = np.linalg.svd(np.frombuffer(raw).reshape(d, d))
                n = min(k, d)
                v = [row * np.sign(row[np.argmax(np.abs(row))]) for row in vt[:n]]
                yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array(s[:n]), pa.array([x.tolist() for x in v], pa.list_(pa.float64()))], names=["k", "sigma", "v"])

    return triangular_factor(rows, vector_col, max_columns).mapInArrow(solve, "k int, sigma double, v array<double>")


def svd_topk(spark: SparkSession, rows: DataFrame, vector_col: str, k: int) -> DataFrame:
    """Top-k singular values ``(k, sigma)`` of a tall matrix (one row per vector)."""
    return singular_pairs(rows, vector_col, k).select("k", "sigma")


def pair_residuals(pairs: DataFrame, gram: DataFrame) -> DataFrame:
    """``(k, sigma, residual)``: by how much ``G v`` misses ``sigma^2 v`` for
    each pair, relative to the largest ``sigma^2``.  G is formed from the rows
    anew, so the check doesn't rest on the factor."""
    v = pairs.select("k", "sigma", F.posexplode("v").alias("j", "x"))
    image = gram.join(v, "j").groupBy("k", "i").agg(F.sum(F.col("g") * F.col("x")).alias("gx"))
    off: Column = F.col("gx") - F.col("sigma") * F.col("sigma") * F.col("x")
    miss = (image.join(v.withColumnRenamed("j", "i"), ["k", "i"])
                 .groupBy("k", "sigma").agg(F.sqrt(F.sum(off * off)).alias("miss")))
    top = F.max(F.col("sigma") * F.col("sigma")).over(Window.partitionBy())        # k rows
    return miss.select("k", "sigma", F.try_divide(F.col("miss"), top).alias("residual"))
