"""Whitening of embeddings by distributed block matrices.

Every entry becomes a whole number, so sums are exact. Rows are numbered, centred and dealt into the blocks
of an MLlib ``BlockMatrix``; its transpose times itself is the scatter matrix, which alone goes to the
driver (dimension squared) for its eigenvectors. A second product, with the matrix of eigenvectors over
the root of their eigenvalues, projects all rows.

The scatter matrix is one block or few, and a plain product brings all blocks of rows to the tasks of
those. So the middle dimension is split: every task multiplies some blocks of rows and only the small
products are added up.

Cases: null vectors, empty ones and those with a null or non-finite entry, or with an entry beyond
2^42, are dropped, and so are vectors whose length isn't the commonest. Repeated rows each count and
are each returned; a null vec_id is returned as it is. Components whose eigenvalue is nought (to double
precision, against the largest) can't be whitened and are left out, so a table of one vector, or of equal ones,
gives no rows, as an empty one does. ``deviation`` is null where it has over 38 digits. Long vectors
are cut into blocks of columns. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import short_batches, stored
from tillworks.llm.positions import numbered_rows
from tillworks.llm.vectors import finite, usual_length

SCALE, SHIFT = 1024, 100_000
#: Beyond this an entry times SCALE is no longer exact.
LARGEST = 2.0 ** 42
ROWS, COLUMNS = 4096, 1024
EXACT = "decimal(38,0)"


def whole_numbers(frame: DataFrame, vector: str, ident: str) -> DataFrame:
    """(ident, x): the vectors that take part, as whole numbers."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = frame.select(F.col(f"`{ident}`").alias(ident), v.alias("v")).where(finite(F.col("v")) & F.forall("v", lambda c: F.abs(c) <= LARGEST))
    length = usual_length(rows, "v")
    return rows.where(F.size("v") == length).select(ident, F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right, the middle dimension split into as many parts. Python's ``multiply`` has no
    argument for that, so the JVM method of the same name is called."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the covariance, and its trace."""
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    usable = values > max(values[0], 0.0) * len(values) * np.finfo("f8").eps
    return values[usable][:most], vectors[:, usable][:, :most], float(np.trace(scatter)) / n


def blocks_of(matrix: np.ndarray, spark) -> BlockMatrix:
    """A small matrix cut as ``COLUMNS`` of a tall one are."""
    parts = [((i, 0), Matrices.dense(len(p), p.shape[1], p.flatten(order="F").tolist()))
             for i, p in enumerate(matrix[lo:lo + COLUMNS] for lo in range(0, len(matrix), COLUMNS))]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), COLUMNS, matrix.shape[1], matrix.shape[0], matrix.shape[1])


def whitened(frame: DataFrame, vector: str = "embedding", ident: str = "vec_id", most: int = 8) -> DataFrame:
    """(ident, n, deviation, whitened, explained, identity_error): one row for each vector; ``whitened`` and
    ``explained`` are arrays by component."""
    spark = frame.sparkSession
    short_batches(spark)
    rows = numbered_rows(whole_numbers(frame, vector, ident), [], [], "row", "n")
    sums = rows.select("n", F.posexplode("x").alias("j", "c")).groupBy("j").agg(
        F.sum(F.col("c").cast(EXACT)).alias("s"), F.max("n").alias("n")).orderBy("j").collect()  # a row for each dimension
    empty = f"{ident} {rows.schema[ident].dataType.simpleString()}, n long, deviation {EXACT}, whitened array<double>, explained array<double>, identity_error double"
    if not sums:
        return spark.createDataFrame([], empty)
    n, d = sums[0].n, len(sums)
    total = F.array(*[F.lit(r.s).cast(EXACT) for r in sums])
    # n * x - S, exactly; divided by n only then, so that no digits go to a rounded mean.
    off = F.zip_with("x", total, lambda c, s: (F.lit(n).cast("decimal(19,0)") * c.cast("decimal(19,0)") - s).cast(EXACT))
    deviation = F.aggregate("off", F.lit(0).cast(EXACT), lambda a, c: F.try_add(a, F.try_multiply(c, c)).cast(EXACT))
    centred = stored(rows.select(ident, "row", off.alias("off")).select(
        ident, "row", deviation.alias("deviation"), F.transform("off", lambda c: c.cast("double") / F.lit(float(n))).alias("centred")), "centred")

    indexed = MLUtils.convertVectorColumnsFromML(centred.select(F.col("row").alias("index"), array_to_vector("centred").alias("vector")), "vector")
    tall = IndexedRowMatrix(indexed, n, d).toBlockMatrix(ROWS, COLUMNS)
    splits = min(-(-n // ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    scatter = product(tall.transpose(), tall, splits).toLocalMatrix().toArray()
    values, vectors, trace = components((scatter + scatter.T) / 2, n, most)
    if not len(values):
        return spark.createDataFrame([], empty)

    flat = tall.multiply(blocks_of(vectors / np.sqrt(values), spark)).toIndexedRowMatrix()
    projected = spark.createDataFrame(flat.rows.map(_plain), "row long, whitened array<double>")
    out = stored(centred.select(ident, "row", "deviation").join(projected, "row").select(ident, "deviation", "whitened"), "whitened")
    pairs = [(i, j) for i in range(len(values)) for j in range(i + 1)]
    covariances = out.agg(*[F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covariances, pairs))
    return out.select(
        ident, F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(float(v / trace)) for v in values]).alias("explained"), F.lit(float(error)).alias("identity_error"))


def _plain(row) -> tuple[int, list[float]]:
    return row.index, row.vector.toArray().tolist()
