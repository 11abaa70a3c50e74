"""Whitening of embeddings with Spark MLlib's BlockMatrix.

Vectors become integers (``floor(scale * x) + shift``), are numbered, centred
exactly and placed as rows of a distributed BlockMatrix of one block column.
Its transpose times itself is the scatter matrix, whose symmetric eigenvectors
are taken on the driver (dims * dims doubles); the BlockMatrix times the matrix
``eigenvector / sqrt(eigenvalue)`` projects the rows.  The projected matrix's
own product with its transpose gives the covariance of the result, whose
distance from the identity is reported.

Both products over rows are split along the row blocks, so a task multiplies a
few blocks and only dims * dims partial results meet; a plain product would
send all blocks of a one-column matrix to one task.

Numbers: with n rows and sums S, an entry of the centred row is the integer
n * x - S divided by n, one rounding.  Sums are decimals, and ``deviation``,
the sum of (n * x - S)**2, is exact (a decimal on the way; an error if it does
not fit 64 bits).  Components are numbered by falling eigenvalue; their sign is
chosen so that the entry with the largest size is positive.

Defined results: rows whose vector is null, or holds null or non-finite
entries, are left out; of the rest, the vectors of the most frequent length
count (of equally frequent lengths the larger one) and others are left out, as
are vectors of length 0; repeated rows and ids are rows of their own; null ids
stay null; a component whose eigenvalue is not over 1e-12 of the largest holds
no variance and is reported with ``whitened`` 0 (it does not count in
``identity_error``); no rows give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import need, write_and_read

ROWS_PER_BLOCK = 4096
BLOCKS_PER_TASK = 4
LEAST_SHARE = 1e-12
LOCAL_BITS = 33     # monotonically_increasing_id: the partition's number is above


def integer_rows(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """``index`` (0, 1, ...), ``id`` and ``x`` (integers) of the usable vectors, in shared scratch."""
    need(df, id_col, vector_col)
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    x = F.transform("v", lambda e: F.floor(e * F.lit(float(scale))) + F.lit(shift).cast("bigint"))
    rows = write_and_read(rows.select("id", x.alias("x"), F.monotonically_increasing_id().alias("_at")), "vectors")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).limit(2).collect()
    rows = rows.filter(F.size("x") == (most[0]["size"] if most else 0))
    # numbers without gaps: a task's offset is the number of rows of the tasks before (one row per task)
    if len(most) > 1:
        rows = write_and_read(rows.select("id", "x", F.monotonically_increasing_id().alias("_at")), "vectors")
    part = F.shiftright("_at", LOCAL_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_at").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select((F.col("_off") + local).alias("index"), "id", "x"))


def dimension_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension."""
    got = (rows.select(F.posexplode("x").alias("dim", "v")).groupBy("dim")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect())
    return (int(got[0].n), [int(r.s) for r in got]) if got else (0, [])


def scaled_deviations(n: int, sums: list[int], x: str = "x") -> Column:
    """n * x - S of each dimension, an exact integer."""
    return F.zip_with(F.col(x), F.array(*[F.lit(s).cast("bigint") for s in sums]),
                      lambda v, s: v * F.lit(n).cast("bigint") - s)


def times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``, its inner dimension in ``splits`` parts (an overload that the Python class lacks)."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def gram(m: BlockMatrix, rows: int) -> np.ndarray:
    """Transpose of ``m`` times ``m`` as a local array (columns * columns)."""
    blocks = -(-rows // m.rowsPerBlock)
    return times(m.transpose(), m, max(1, blocks // BLOCKS_PER_TASK)).toLocalMatrix().toArray()


def block_matrix(rows: DataFrame, n: int, dims: int, rows_per_block: int) -> BlockMatrix:
    """Rows ``index``, ``v`` (array of doubles) as a BlockMatrix of one block column."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(rows_per_block, dims)


def principal(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors as columns) of scatter / n by falling eigenvalue, and the trace."""
    cov = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(top < 0, -1.0, 1.0), float(np.trace(cov))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32,
           scale: int = 64, shift: int = 1_000_000, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Per usable row: ``id``, ``n``, ``deviation``, ``whitened`` (array of at most
    ``components`` doubles), ``explained`` (array: share of the variance of each
    component) and ``identity_error``."""
    spark = df.sparkSession
    rows = integer_rows(df, id_col, vector_col, scale, shift)
    n, sums = dimension_sums(rows)
    id_type = rows.schema["id"].dataType.simpleString()
    if n == 0:
        return spark.createDataFrame([], f"id {id_type}, n bigint, deviation bigint, whitened array<double>, "
                                         "explained array<double>, identity_error double")
    dims = len(sums)
    whole = rows.select("index", "id", scaled_deviations(n, sums).alias("w"))
    centred = whole.select("index", F.transform("w", lambda v: v.cast("double") / F.lit(float(n))).alias("v"))
    matrix = block_matrix(centred, n, dims, rows_per_block)
    values, vectors, trace = principal(gram(matrix, n), n, components)
    held = values > LEAST_SHARE * max(float(values.max()), 1e-300)
    weights = np.where(held, vectors / np.sqrt(np.where(held, values, 1.0)), 0.0)
    k = weights.shape[1]
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(dims, k, weights.ravel(order="F").tolist()))], 1),
                        dims, k, dims, k)
    projected = matrix.multiply(right)
    # the projected rows' means are zero, as the integers n * x - S add up to zero
    error = np.abs(gram(projected, n) / n - np.eye(k))[np.ix_(held, held)]
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("whitened"))
    square = F.aggregate(F.transform("w", lambda v: v.cast("decimal(19,0)") * v.cast("decimal(19,0)")),
                         F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)")).cast("bigint")
    shares = values / trace if trace > 0 else np.zeros(k)
    out = whole.select("index", "id", square.alias("deviation")).join(found, "index")
    return out.select("id", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.array(*[F.lit(float(s)) for s in shares]).alias("explained"),
                      F.lit(float(error.max()) if error.size else 0.0).alias("identity_error"))
