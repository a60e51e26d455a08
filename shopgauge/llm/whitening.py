"""Whitening of embeddings with Spark MLlib's distributed block matrices.

The distinct vectors, centred, are indexed rows of a BlockMatrix. Its transpose times
itself is the scatter matrix, which has one entry for each pair of dimensions and is
decomposed on the driver. The rows times the whitening matrix, again as block
matrices, are the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import store

#: An entry c becomes floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 64, 1_000_000
#: Entries from which on a vector counts as not finite: beyond, whole numbers would not be exact.
LARGEST = float(1 << 40)
#: Rows and columns of a block, and blocks that meet in one task of a product.
ROWS, COLUMNS, BLOCKS = 1024, 1024, 8


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """``vec_id, x``: the rows whose vector is not null, without null or non-finite entries, and of the commonest width."""
    c = F.col(vector)
    finite = F.forall(c, lambda v: F.coalesce(F.abs(v.cast("double")) < LARGEST, F.lit(False)))
    rows = vectors.where(c.isNotNull() & (F.size(c) > 0) & finite)
    width = rows.groupBy(F.size(c).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if width is None:
        rows = rows.where(F.lit(False))
    else:
        rows = rows.where(F.size(c) == width["width"])
    whole = F.transform(c, lambda v: F.floor(STEPS * v.cast("double")).cast("long") + SHIFT)
    return rows.select(F.col(id_).alias("vec_id"), whole.alias("x"))


def sums(fit: DataFrame) -> list[int]:
    """The exact sum of each dimension. Batches are added up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                total = flat.sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["dim", "total"])

    parts = fit.select("x").mapInArrow(run, "dim int, total long")
    rows = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return [int(r["total"]) for r in sorted(rows, key=lambda r: r["dim"])]


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, stored, with ``index`` from 0 without gaps. One count for each partition reaches the driver."""
    spark = df.sparkSession
    made = store(df.withColumn("made", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("made", 33), F.col("made").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["part"], r["count"]) for r in made.groupBy(part.alias("part")).count().collect())
    starts, at = [], 0
    for number, size in sizes:
        starts.append((number, at))
        at += size
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    return made.withColumn("part", part).join(offsets, "part").withColumn("index", F.col("start") + place).drop("made", "part", "start")


def blocks_of(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """A BlockMatrix of ``rows`` (``index``, ``vector`` as an array of doubles)."""
    indexed = rows.select("index", array_to_vector("vector").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), n, width)
    return matrix.toBlockMatrix(ROWS, COLUMNS)


def squared(matrix: BlockMatrix) -> np.ndarray:
    """The transpose of ``matrix`` times itself, columns by columns.

    The long middle dimension is cut into splits of ``BLOCKS`` blocks, which are
    multiplied in tasks of their own and then added up. The Python method has
    no such argument; the one that it calls has.
    """
    turned = matrix.transpose()
    splits = ceil(matrix.numRows() / (ROWS * BLOCKS))
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, COLUMNS, COLUMNS).toLocalMatrix().toArray()


def whiten(vectors: DataFrame, components: int = 16, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each usable vector and component.

    Equal vectors (after they became whole numbers) count once in the fit and
    get the same values. Vectors that are null or empty, hold null or
    non-finite entries (of ``LARGEST`` or more too), or differ in width from
    most are left out, null ids are kept. Components without variance are left
    out; so a table without two different vectors gives an empty one.
    ``deviation`` is null where it exceeds a long. Other columns aren't read.

    The driver gets sums by dimension, matrices of dimensions by dimensions,
    one count for each partition and, inside MLlib, the places of the blocks
    of ``ROWS`` rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_, vector)
    fit = numbered(rows.select("x").distinct(), "whitening-fit")
    n = fit.count()
    kind = rows.schema["vec_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if n < 2:
        return empty
    total = sums(fit)
    width = len(total)
    whole = F.array(*(F.lit(s // n).cast("long") for s in total))
    rest = F.array(*(F.lit(s % n / n) for s in total))
    centred = F.zip_with(F.zip_with("x", whole, lambda x, q: (x - q).cast("double")), rest, lambda d, r: d - r)
    matrix = blocks_of(fit.select("index", centred.alias("vector")), n, width)
    values, axes = np.linalg.eigh(squared(matrix) / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > max(values[0], 0) * width * np.finfo(float).eps).sum()))
    if not k:
        return empty
    turn = axes[:, :k] / np.sqrt(values[:k])
    cut = range(0, width, COLUMNS)
    parts = [((b, 0), Matrices.dense(len(turn[a : a + COLUMNS]), k, turn[a : a + COLUMNS].ravel(order="F").tolist())) for b, a in enumerate(cut)]
    whitening = BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), COLUMNS, k, width, k)
    projected = matrix.multiply(whitening)
    error = float(np.abs(squared(projected) / n - np.eye(k)).max())
    indexed = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    values_of = MLUtils.convertVectorColumnsToML(indexed, "vector").select("index", vector_to_array("vector").alias("whitened"))
    # n * x - S, without leaving the range of a long where the result fits one
    apart = F.zip_with(
        F.transform("x", lambda x: F.try_multiply(F.lit(n).cast("long"), x)),
        F.array(*(F.lit(s).cast("long") if abs(s) < 1 << 63 else F.lit(None).cast("long") for s in total)),
        F.try_subtract,
    )
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda t, v: F.try_add(t, F.try_multiply(v, v)))
    done = store(fit.select("index", "x", deviation.alias("deviation")).join(values_of, "index").drop("index"), "whitening-done")
    shares = F.array(*(F.lit(float(e / values.sum())) for e in values[:k]))
    return rows.join(done, "x").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
