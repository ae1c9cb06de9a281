"""Embedding whitening with distributed block matrices.

Entries are put on an integer grid, ``x = floor(scale * entry)``, so that sums, means and equality are
exact. The fit list holds each distinct grid vector once. Its centred rows are indexed into the blocks
of an MLlib ``BlockMatrix``, whose transpose times itself is the scatter; the small scatter matrix is
decomposed on the driver, and a second block product puts every row on the components.

The middle dimension of the transpose product is cut into parts of ``SPLIT_BLOCKS`` blocks, each
summed by a task of its own, so no task multiplies all rows. The driver holds matrices of dimension x
dimension and the block grid's positions (one pair of numbers for ``ROWS_PER_BLOCK`` rows). Row numbers
come from numbered, stored partitions, so a lost executor repeats its tasks with the same numbers.

Null vectors and vectors that hold a null or non-finite entry are left out; rows with a null id and
repeated rows stay, each on its own. Vectors of one length are whitened among themselves: a length has
its own mean, components and numbers. Directions whose variance is zero up to rounding get no
component, so a length of one distinct vector and vectors without entries give no rows. Grid entries
beyond a long are cut to its range; a ``deviation`` beyond a long is null. Components of equal variance
may turn. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txnsieve.llm.common import ship_package, slices
from txnsieve.session import staged

SCALE = 256
ROWS_PER_BLOCK = 2048
COLS_PER_BLOCK = 256
SPLIT_BLOCKS = 16
LONG = 2**63 - 1
BLOCKS = T.StructType(
    [
        T.StructField("at", T.StructType([T.StructField("_1", T.LongType(), False), T.StructField("_2", T.LongType(), False)]), False),
        T.StructField("matrix", MatrixUDT(), False),
    ]
)
ROWS = "vec_id long, whitened array<double>, deviation long, n long, explained array<double>, identity_error double"


def grid_vector(vector: Column, scale: int = SCALE) -> Column:
    """The integer grid vector; null where the vector is null or holds a null or non-finite entry."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long")))


def indexed(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored once, with ``_index`` from 0 without gaps; no shuffle, one counted row per partition."""
    stored = staged(df.withColumn("_mono", F.monotonically_increasing_id()), label)
    stored = stored.withColumn("_part", F.shiftright("_mono", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    place = F.col("_mono").bitwiseAND(F.lit(2**33 - 1))
    return stored.join(F.broadcast(starts), "_part").withColumn("_index", F.col("_start") + place).drop("_mono", "_part", "_start")


def exact_gaps(x: np.ndarray, total: list[int], n: int) -> np.ndarray:
    """``n * x - total`` for rows of grid entries, in Python integers where a long is too short."""
    reach = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) * n + max(map(abs, total))
    wide = x if reach <= LONG else x.astype(object)
    return wide * n - np.array(total, dtype=wide.dtype)


def grid_rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def blocks_of(total: list[int], n: int, wide: int) -> Callable[[pa.Table], pa.Table]:
    """A task that turns the grid rows of one block row into centred blocks of ``wide`` columns each."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_index").combine_chunks()
        centred = (exact_gaps(grid_rows(rows.to_batches()[0], len(total)), total, n) / n).astype(np.float64)
        block = rows.column("_block")[0].as_py()
        cuts = range(0, len(total), wide)
        parts = [np.ascontiguousarray(centred[:, c : c + wide].T) for c in cuts]  # column by column
        at = [{"_1": block, "_2": i} for i in range(len(parts))]
        matrix = [
            {"type": 1, "numRows": p.shape[1], "numCols": p.shape[0], "colPtrs": None, "rowIndices": None, "values": p.ravel(), "isTransposed": False}
            for p in parts
        ]
        return pa.table([pa.array(at, to_arrow_schema(BLOCKS).field("at").type), pa.array(matrix, to_arrow_schema(BLOCKS).field("matrix").type)], names=BLOCKS.names)

    return run


def block_matrix(rows: DataFrame, total: list[int], n: int, count: int) -> BlockMatrix:
    """The centred rows of ``_index`` and ``x``, indexed from 0 to ``count``, as a distributed block matrix."""
    by_block = rows.select("_index", "x", F.floor(F.col("_index") / ROWS_PER_BLOCK).alias("_block")).groupBy("_block")
    blocks = by_block.applyInArrow(blocks_of(total, n, COLS_PER_BLOCK), BLOCKS)
    made = callMLlibFunc("createBlockMatrix", blocks, ROWS_PER_BLOCK, COLS_PER_BLOCK, count, len(total))
    return BlockMatrix(made, ROWS_PER_BLOCK, COLS_PER_BLOCK)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, as a local array of width x width."""
    splits = ceil(matrix.numRowBlocks / SPLIT_BLOCKS)
    # The Python call lacks the number of splits of the middle dimension.
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def times(matrix: BlockMatrix, local: np.ndarray) -> BlockMatrix:
    """The block matrix times a local matrix, whose columns stay together in one column of blocks."""
    high, wide = local.shape
    cuts = [local[c : c + COLS_PER_BLOCK] for c in range(0, high, COLS_PER_BLOCK)]
    blocks = [((i, 0), Matrices.dense(*part.shape, part.ravel(order="F").tolist())) for i, part in enumerate(cuts)]
    other = BlockMatrix(SparkSession.active().sparkContext.parallelize(blocks, 1), COLS_PER_BLOCK, wide, high, wide)
    return matrix.multiply(other)


def block_rows(rows_per_block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives the rows of blocks, each with its index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in zip(batch.column(0), batch.column(1)):
                first, high, wide = at["_1"].as_py() * rows_per_block, block["numRows"].as_py(), block["numCols"].as_py()
                values = block["values"].values.to_numpy().reshape((high, wide), order="C" if block["isTransposed"].as_py() else "F")
                ends = pa.array(np.arange(high + 1, dtype=np.int32) * wide)
                index = pa.array(np.arange(first, first + high, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([index, pa.ListArray.from_arrays(ends, pa.array(values.ravel()))], names=["_index", "whitened"])

    return run


def deviations(total: list[int], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that adds up the squares of ``n * x - total`` exactly; null beyond a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            gap = exact_gaps(grid_rows(batch, len(total)), total, n)
            most = int(np.abs(gap).max(initial=0))
            sums = (gap * gap).sum(axis=1) if most * most * len(total) <= LONG else (gap.astype(object) ** 2).sum(axis=1)
            sums = pa.array([int(s) if s <= LONG else None for s in sums], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_index"), batch.column("vec_id"), sums], names=["_index", "vec_id", "deviation"])

    return run


@dataclass(frozen=True)
class Whitening:
    """Mean (``total / n``), whitening matrix (one column per component) and how far it explains and holds."""

    n: int
    total: list[int]
    matrix: np.ndarray
    explained: list[float]
    identity_error: float


def decompose(spread: np.ndarray, n: int, components: int | None) -> tuple[np.ndarray, list[float]]:
    """Whitening matrix and share of variance per component, by falling variance."""
    covariance = (spread + spread.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values.max(initial=0.0), 0.0) * len(values) * np.finfo(float).eps
    kept = int(real.sum()) if components is None else min(int(real.sum()), components)
    trace = float(np.trace(covariance))
    return vectors[:, :kept] / np.sqrt(values[:kept]), [float(v) / trace for v in values[:kept]]


def fit(grid: DataFrame, width: int, components: int | None = None) -> Whitening | None:
    """Fits grid vectors ``x`` of one width, each distinct vector once; None without any spread."""
    spark = grid.sparkSession
    distinct = indexed(grid.select("x").distinct(), "whitening-fit")
    each = distinct.select(F.posexplode("x").alias("at", "value"))
    sums = {r["at"]: int(r["s"]) for r in each.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect()}
    n, total = distinct.count(), [sums.get(i, 0) for i in range(width)]
    if not n or not width:
        return None
    ship_package(spark)
    blocks = block_matrix(distinct, total, n, n)
    matrix, explained = decompose(scatter(blocks), n, components)
    if not explained:
        return None
    found = scatter(times(blocks, matrix)) / n
    error = float(np.abs(found - np.eye(len(explained))).max())
    return Whitening(n, total, matrix, explained, error)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``whitened`` and ``deviation`` of indexed grid rows (``_index``, ``vec_id``, ``x``) on every component."""
    ship_package(rows.sparkSession)
    blocks = times(block_matrix(rows, model.total, model.n, rows.count()), model.matrix)
    placed = callMLlibFunc("getMatrixBlocks", blocks._java_matrix_wrapper._java_model)
    placed = placed.mapInArrow(block_rows(ROWS_PER_BLOCK), "_index long, whitened array<double>")
    moved = rows.select("_index", "vec_id", "x").mapInArrow(deviations(model.total, model.n), "_index long, vec_id long, deviation long")
    return moved.join(placed, "_index")


def whiten(
    vectors: DataFrame, components: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """``vec_id, whitened, deviation, n, explained, identity_error`` per usable row.

    ``whitened`` and ``explained`` have one entry per component, ``components`` of them or all.
    ``deviation`` is the squared distance from the mean in units of the grid over ``n``, exact.
    """
    spark = vectors.sparkSession
    grid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), grid_vector(F.col(vector_col), scale).alias("x"))
    grid = staged(grid.where("x IS NOT NULL"), "whitening-grid")
    parts = []
    for row in grid.groupBy(F.size("x").alias("width")).count().collect():
        of_width = grid.where(F.size("x") == row["width"])
        model = fit(of_width, row["width"], components)
        if model is None:
            continue
        placed = project(indexed(of_width, "whitening-rows"), model)
        parts.append(
            placed.select(
                "vec_id", "whitened", "deviation", F.lit(model.n).cast("long").alias("n"),
                F.lit(model.explained).cast("array<double>").alias("explained"),
                F.lit(model.identity_error).alias("identity_error"),
            )
        )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ROWS)
