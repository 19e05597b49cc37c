"""Embedding whitening over MLlib block matrices.

Vectors are first put on a whole-number grid, so that their sums and deviations are
exact. The centred rows are numbered and cut into blocks; the transposed matrix times
itself gives the scatter of all rows, split over tasks by rows and added as small square
blocks. The driver only holds matrices as wide as a vector is long: it takes the scatter
apart into eigenvectors, and the block matrix times the whitening matrix projects the rows.

Defined results: rows without a vector, with an empty one, with null or non-finite entries,
or with an entry whose number on the grid is beyond `Grid.largest`, are left out, and so are
vectors that are not as long as most are (of lengths equally frequent, the longest counts).
Repeated rows and rows without `vec_id` are fitted and returned like any other. A component
without variance has no whitened values (null) and does not count for `identity_error`,
which is 0 where no component has any; `explained` is null where nothing varies. A deviation
that does not fit 64 bits is null. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import give_back
from tallyhouse.operators.dense_key import PLACE, numbered
from tallyhouse.sources.storage import TableStore


class Grid(NamedTuple):
    """A component c becomes floor(scale * c) + shift."""

    scale: int = 64
    shift: int = 1_000_000
    #: Numbers on the grid stay below this, so that a batch of them adds up within 64 bits.
    largest: int = 1 << 40


class Blocks(NamedTuple):
    rows: int = 4096
    columns: int = 1024
    #: Row blocks that one task of a product multiplies and adds.
    per_task: int = 4


class Fit(NamedTuple):
    """What all rows share; nothing here grows with their number."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    #: One column per component: its eigenvector over the root of its variance, zeros without variance.
    matrix: np.ndarray


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def on_grid(vectors: DataFrame, grid: Grid) -> DataFrame:
    """(vec_id, x) of the rows that take part, whatever their length."""

    def usable(value: Column) -> Column:
        number = value.cast("double")
        inside = F.abs(F.floor(number * grid.scale).cast("double")) < float(grid.largest - grid.shift)
        return F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")) & inside, F.lit(False))

    def placed(value: Column) -> Column:
        return F.floor(value.cast("double") * grid.scale) + F.lit(grid.shift).cast("bigint")

    whole = (F.size("embedding") > 0) & F.forall("embedding", usable)
    return vectors.where(F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", placed).alias("x")
    )


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of the vectors of the commonest length and their exact sum per dimension.

    Every task sends one row per length it has met.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("x").offsets.to_numpy())
            found = {"width": [], "n": [], "sums": []}
            for width in np.unique(lengths):
                chosen = batch.column("x").filter(pa.array(lengths == width))
                found["width"].append(int(width))
                found["n"].append(len(chosen))
                found["sums"].append(_matrix(chosen, int(width)).sum(axis=0))
            if found["n"]:
                kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds)], list(found))
        give_back()

    parts = rows.select("x").mapInArrow(partial, "width int, n long, sums array<long>")
    added = (
        parts.select("width", "n", F.posexplode("sums").alias("dimension", "part"))
        .groupBy("width", "dimension")
        .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        .groupBy("width")
        .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("dimension", "total"))).alias("sums"))
        .orderBy(F.desc("n"), F.desc("width"))
        .first()
    )
    return (0, []) if added is None else (added["n"], [int(entry["total"]) for entry in added["sums"]])


def _centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """(index, deviation, centred): x - sums/n, without rounding x or the sums first."""
    base = np.array([total // n for total in sums], np.int64)
    rest = np.array([total % n for total in sums], np.int64)

    def centre(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = _matrix(batch.column("x"), len(base)) - base
            far = int(max(away.max(), -away.min(), 0)) + 1  # away <= far, and rest / n < 1
            if (far * n) ** 2 * len(base) < 1 << 63:
                times = away * n - rest
                deviation = pa.array((times * times).sum(axis=1), pa.int64())
            else:
                exact = [sum((a * n - r) ** 2 for a, r in zip(row, rest.tolist())) for row in away.tolist()]
                deviation = pa.array([value if value < 1 << 63 else None for value in exact], pa.int64())
            values = away - rest / n
            offsets = np.arange(0, values.size + 1, len(base), dtype=np.int32)
            centred = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("index"), deviation, centred], ["index", "deviation", "centred"])
        give_back()

    return rows.select("index", "x").mapInArrow(centre, "index long, deviation long, centred array<double>")


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left * right, the sum over inner blocks dealt over `splits` tasks per block of the result."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _gram(matrix: BlockMatrix, blocks: Blocks) -> np.ndarray:
    """Transposed times itself, as a local matrix; symmetric."""
    splits = max(1, -(-matrix.numRowBlocks // blocks.per_task))
    local = _times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    return (local + local.T) / 2


def _decompose(covariance: np.ndarray, n: int, sums: list[int], components: int) -> Fit:
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # Either sign would do: the entry of largest size is made positive, so that runs agree.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1.0, 1.0)
    varies = values > max(values[0], 0.0) * len(covariance) * np.finfo(float).eps
    scale = np.where(varies, 1.0 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    return Fit(n, np.array(sums, object), np.where(varies, values, 0.0), float(np.trace(covariance)), vectors * scale)


def _as_blocks(matrix: np.ndarray, df: DataFrame, blocks: Blocks, width: int) -> BlockMatrix:
    """A local matrix in blocks of `width` rows."""
    parts = [
        ((at // width, 0), Matrices.dense(len(part), matrix.shape[1], part.ravel("F").tolist()))
        for at in range(0, len(matrix), width)
        for part in [matrix[at : at + width]]
    ]
    spread = df.sparkSession.sparkContext.parallelize(parts, len(parts))
    return BlockMatrix(spread, width, matrix.shape[1], *matrix.shape)


def whiten(vectors: DataFrame, components: int = 32, grid: Grid = Grid(), blocks: Blocks = Blocks()) -> DataFrame:
    """One row per remaining vector and component, numbered from 1 by falling variance."""
    spark = vectors.sparkSession
    rows = on_grid(vectors, grid)
    n, sums = exact_sums(rows)
    if not n:
        return spark.createDataFrame([], SCHEMA)
    store = TableStore(spark)
    alike = rows.where(F.size("x") == len(sums)).withColumn(PLACE, F.monotonically_increasing_id())
    indexed = numbered(alike, "number", store, "grid").df.withColumn("index", F.col("number") - 1)
    centred = store.save(_centred(indexed, n, sums), "centred").df

    as_vectors = centred.select("index", array_to_vector("centred").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(as_vectors, "vector"), n, len(sums))
    width = min(len(sums), blocks.columns)
    block_matrix = matrix.toBlockMatrix(blocks.rows, width)
    fit = _decompose(_gram(block_matrix, blocks) / n, n, sums, components)

    projected = block_matrix.multiply(_as_blocks(fit.matrix, vectors, blocks, width))
    off = np.abs(_gram(projected, blocks) / n - np.eye(fit.matrix.shape[1]))
    varies = fit.eigenvalues > 0
    error = float(off[np.ix_(varies, varies)].max()) if varies.any() else 0.0

    whitened = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    whitened = store.save(whitened.select("index", vector_to_array("vector").alias("values")), "whitened").df
    return _shaped(indexed.join(centred.drop("centred"), "index").join(whitened, "index"), fit, error)


def _shaped(rows: DataFrame, fit: Fit, error: float) -> DataFrame:
    """The joined rows, one per component."""
    shares = [float(value / fit.trace) if fit.trace > 0 else None for value in fit.eigenvalues]
    share = F.array(*(F.lit(value).cast("double") for value in shares))
    varies = F.array(*(F.lit(bool(value > 0)) for value in fit.eigenvalues))
    long = rows.select("vec_id", "deviation", F.posexplode("values").alias("at", "value"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("bigint").alias("n"),
        "deviation",
        F.when(varies[F.col("at")], F.col("value")).alias("whitened"),
        share[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
