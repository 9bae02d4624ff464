"""Whitening of embeddings with distributed block matrices.

Entries are rounded to whole numbers, x = floor(1024 c) + 100000, so that sums and deviations are exact.
Rows centred at the mean are indexed from 0 and dealt into a MLlib BlockMatrix of ``BLOCK_ROWS`` rows by
``BLOCK_COLUMNS`` dimensions.  Its transpose times itself is the scatter matrix: the product is formed in
as many parts along the rows as there are blocks of rows, and the parts are added, so no task holds more
than a few blocks.  The scatter matrix, dimensions squared, is small; its eigenvectors are found on the
driver.  A second multiplication with the whitening matrix (eigenvectors over roots of eigenvalues)
projects all rows.  How far the result's covariance is from the identity is measured the same way.
Vectors stay in the JVM; no Python worker sees them.

Defined cases: vectors that are null, empty, or hold null or non-finite entries are dropped; repeated
rows count and are returned each for itself; vectors of another length are whitened among their own;
an empty table gives no rows.  Components without variance (to rounding) have no whitened value and
are not returned, so constant columns and a single row give fewer or none; the order of components of
equal variance is open.  Sums beyond a long raise an error.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace

BLOCK_ROWS = 2048
BLOCK_COLUMNS = 512
SCALE, SHIFT = 1024, 100_000
_WITHIN = 33  # monotonically_increasing_id: number within the partition in the lower bits

WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: the mean, the matrix that whitens centred rows, and the components' share of variance."""

    mean: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray


def usable(vectors: DataFrame, column: str = "embedding") -> Column:
    """Whether a vector has entries, all of them finite."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & ~bad


def rounded(column: str = "embedding") -> Column:
    return F.transform(column, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("long"))


def _indexed(rows: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Rows with ``index``, from 0 without gaps: the rows before a partition plus the place within it."""
    placed = work.keep(rows.withColumn("place", F.monotonically_increasing_id()), f"{name}-placed")
    part = F.shiftright("place", _WITHIN).alias("part")
    counts = {r["part"]: r["n"] for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)  # one number per partition
    before = np.concatenate([[0], np.cumsum([counts[p] for p in parts])])[: len(parts)]
    starts = placed.sparkSession.createDataFrame(
        [(int(p), int(b)) for p, b in zip(parts, before)], "part long, before long"
    )
    within = F.col("place").bitwiseAND((1 << _WITHIN) - 1)
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    return work.keep(joined.select(*rows.columns, (F.col("before") + within).alias("index")), f"{name}-indexed")


def _blocks(rows: DataFrame, n_rows: int, n_columns: int, block_rows: int, block_columns: int) -> BlockMatrix:
    """A block matrix of index and array columns, made inside the JVM."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    matrix = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n_rows, n_columns))
    return matrix.toBlockMatrix(block_rows, block_columns)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, formed in parts along the rows (the Python wrapper lacks that argument)."""
    parts = -(-matrix.numRows() // matrix.rowsPerBlock)
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper._java_model
    product = BlockMatrix(left.call("multiply", right, parts), matrix.colsPerBlock, matrix.colsPerBlock)
    return product.toLocalMatrix().toArray()


def _local(spark, values: np.ndarray, block_rows: int, block_columns: int) -> BlockMatrix:
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(values)]
    frame = spark.createDataFrame(rows, "index long, values array<double>")
    return _blocks(frame, *values.shape, block_rows, block_columns)


def _rows(matrix: BlockMatrix, column: str) -> DataFrame:
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias(column))


def fit(scatter: np.ndarray, mean: np.ndarray, n: int, components: int) -> Whitening:
    """The components of largest variance that have any."""
    covariance = (scatter + scatter.T) / (2 * n)
    variances, vectors = np.linalg.eigh(covariance)
    variances, vectors = variances[::-1], vectors[:, ::-1]
    total = float(np.trace(covariance))
    real = variances > max(total, 0.0) * len(mean) * np.finfo(float).eps
    kept = min(components, int(np.count_nonzero(real)))
    return Whitening(mean, vectors[:, :kept] / np.sqrt(variances[:kept]), variances[:kept] / total if kept else variances[:0])


def _whiten_equal(rows: DataFrame, size: int, components: int, work: Workspace) -> DataFrame | None:
    """Whitening of vectors of one length."""
    spark = rows.sparkSession
    indexed = _indexed(rows, work, f"rows-{size}")
    sums = indexed.agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(size)]).alias("s")).first()
    n, total = sums["n"], sums["s"]
    mean = [s / n for s in total]
    constant = F.array(*[F.lit(m) for m in mean])
    centred = indexed.select("index", F.zip_with("x", constant, lambda x, m: x - m).alias("values"))
    matrix = _blocks(centred, n, size, BLOCK_ROWS, BLOCK_COLUMNS)
    fitted = fit(_scatter(matrix), np.array(mean), n, components)
    kept = fitted.matrix.shape[1]
    if not kept:
        return None
    projected = work.keep(
        _rows(matrix.multiply(_local(spark, fitted.matrix, BLOCK_COLUMNS, kept)), "w"), f"projected-{size}"
    )
    again = _blocks(projected.select("index", F.col("w").alias("values")), n, kept, BLOCK_ROWS, kept)
    means = projected.agg(F.array(*[F.avg(F.col("w")[i]) for i in range(kept)]).alias("m")).first()["m"]
    error = float(np.abs(_scatter(again) / n - np.outer(means, means) - np.eye(kept)).max())

    whole = F.array(*[F.lit(int(s)) for s in total])
    apart = F.zip_with("x", whole, lambda x, s: F.lit(n).cast("long") * x - s)
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda acc, d: acc + d * d)
    shares = F.array(*[F.lit(float(e)) for e in fitted.explained])
    joined = indexed.select("index", "vec_id", deviation.alias("deviation")).join(projected, "index")
    each = joined.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """Every usable vector on the components of largest variance: see ``WHITENED``.

    Columns read: ``vec_id`` and ``embedding``.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "whitening")
    rows = vectors.where(usable(vectors)).select(F.col("vec_id").cast("long").alias("vec_id"), rounded().alias("x"))
    sizes = [row["size"] for row in rows.select(F.size("x").alias("size")).distinct().collect()]
    found = spark.createDataFrame([], WHITENED)
    for size in sorted(sizes):  # one, unless the table mixes models
        part = _whiten_equal(rows.where(F.size("x") == size), size, components, work)
        if part is not None:
            found = found.unionByName(part)
    return found
