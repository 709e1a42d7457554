"""Whitening of embeddings with MLlib's block matrices: scatter by a transposed product, projection by another."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = 2.0**40  # entries are held to this, so that whole numbers stay exact
BLOCK_ROWS = 4_096
SLAB_ROWS = 16_000_000  # rows of one block matrix: MLlib keeps the places of all its blocks on the driver
BLOCKS_A_TASK = 4
NO_VARIANCE = 1e-12  # of the largest eigenvalue; such a component has no whitened values


@dataclass
class Whitening:
    """What the fit list gives: its size, exact sums, and eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray  # all eigenvalues
    vectors: np.ndarray  # dimensions x components
    identity_error: float | None
    exact_long: bool  # whether every deviation fits a long

    @property
    def spread(self) -> np.ndarray:
        """Which components have variance."""
        kept = self.values[: self.vectors.shape[1]]
        return kept > NO_VARIANCE * max(self.values.max(initial=0.0), 0.0)

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(np.where(self.spread, self.values[: self.vectors.shape[1]], 1.0))


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``mid, id, x`` of every row whose vector has only finite entries, stored; ``mid`` numbers rows within partitions."""
    v = col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * held(c)) + F.lit(SHIFT))
    found = rows.select(col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("v").isNotNull() & finite)
    return stored(found.select(F.monotonically_increasing_id().alias("mid"), "id", x.alias("x")), "vectors")


def _slabs(numbered: DataFrame) -> list[tuple[DataFrame, int]]:
    """The rows of a stored frame in slabs with a dense ``index`` in each, and the rows of each slab.

    A slab is some neighbouring partitions of the frame as it was stored. The driver learns the rows of each
    partition; the filter on ``mid`` prunes the files of other slabs.
    """
    part = F.shiftright("mid", 33)
    counts = sorted((r.part, r.n) for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    slabs: list[list[tuple[int, int, int]]] = []
    rows = SLAB_ROWS
    for p, n in counts:
        if rows + n > SLAB_ROWS:
            slabs.append([])
            rows = 0
        slabs[-1].append((p, rows, n))
        rows += n
    out = []
    for slab in slabs:
        begins = numbered.sparkSession.createDataFrame([(p, begin) for p, begin, _ in slab], "part long, begin long")
        mine = numbered.filter(F.col("mid").between(slab[0][0] << 33, (slab[-1][0] + 1 << 33) - 1))
        index = F.col("begin") + F.col("mid").bitwiseAND((1 << 33) - 1)
        joined = mine.join(F.broadcast(begins), part == begins["part"]).withColumn("index", index)  # a row a partition
        out.append((joined.drop("part", "begin"), slab[-1][1] + slab[-1][2]))
    return out


def _deviations(n: int, sums: list[int], kind: str) -> Column:
    """``n * x - S`` of each dimension, exactly."""
    total = F.array(*[F.lit(str(s)).cast(kind) for s in sums])
    return F.zip_with("x", total, lambda x, s: (F.lit(n).cast(kind) * x.cast(kind) - s).cast(kind))


def _centred(n: int, sums: list[int], exact_long: bool) -> Column:
    kind = "bigint" if exact_long else "decimal(38,0)"
    return F.transform(_deviations(n, sums, kind), lambda d: d.cast("double") / F.lit(float(n)))


def _blocks(slab: DataFrame, n_rows: int, vector: Column, d: int) -> BlockMatrix:
    """Rows indexed from 0 as a block matrix of one block column."""
    rows = MLUtils.convertVectorColumnsFromML(slab.select("index", array_to_vector(vector).alias("vector")), "vector")
    return IndexedRowMatrix(rows, n_rows, d).toBlockMatrix(BLOCK_ROWS, d)


def _scatter(a: BlockMatrix) -> np.ndarray:
    """The transposed product of a matrix with itself.

    Blocks of the long inner dimension are dealt to tasks of ``BLOCKS_A_TASK`` and the small products are added up.
    Python's ``multiply`` lacks that parameter of MLlib's and would take all blocks into one task.
    """
    splits = -(-a.numRows() // (BLOCK_ROWS * BLOCKS_A_TASK))
    product = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.colsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def _times(a: BlockMatrix, w: np.ndarray, context) -> BlockMatrix:
    small = Matrices.dense(*w.shape, w.T.ravel().tolist())
    return a.multiply(BlockMatrix(context.parallelize([((0, 0), small)], 1), *w.shape))


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors of ``whole_vectors``; None where there are no entries at all.

    Copies of a vector are combined before the shuffle, so one in a third of the rows is one row a task. Sums are exact.
    The driver gets numbers for each dimension and a matrix of dimensions x dimensions, whatever the number of rows.
    """
    size = vectors.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if not size.high:
        return None
    if size.low != size.high:
        raise ValueError(f"vectors have {size.low} to {size.high} entries; whitening needs one length")
    distinct = vectors.groupBy("x").agg(F.lit(1).alias("one")).select(F.monotonically_increasing_id().alias("mid"), "x")
    fit = stored(distinct, "distinct-vectors")
    by_place = fit.select(F.posexplode("x").alias("place", "c")).groupBy("place")
    whole = F.sum(F.col("c").cast("decimal(20,0)")).alias("s")
    found = by_place.agg(whole, F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).orderBy("place").collect()
    n, sums = found[0].n, [int(r.s) for r in found]
    reach = max(max(abs(n * r.low - int(r.s)), abs(n * r.high - int(r.s))) for r in found)
    d, exact_long = len(sums), len(sums) * reach**2 < 2**63 and n * max(max(abs(r.low), abs(r.high)) for r in found) < 2**63
    matrices = [_blocks(slab, rows, _centred(n, sums, exact_long), d) for slab, rows in _slabs(fit)]
    values, vectors_ = np.linalg.eigh(sum(map(_scatter, matrices)) / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1][:, : min(components, d)]
    signs = np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(vectors_.shape[1])])
    model = Whitening(n, sums, values, vectors_ * signs, None, exact_long)
    if model.spread.any():
        context, w = vectors.sparkSession.sparkContext, model.projection[:, model.spread]
        covariance = sum(_scatter(_times(a, w, context)) for a in matrices) / n
        model.identity_error = float(np.abs(covariance - np.eye(w.shape[1])).max())
    return model


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of every row of ``whole_vectors``."""
    spark, d = vectors.sparkSession, len(model.sums)
    kind = "bigint" if model.exact_long else "decimal(38,0)"
    deviations = _deviations(model.n, model.sums, kind)
    if model.exact_long:
        deviation = F.aggregate(deviations, F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    else:  # null where no long holds it
        squares = F.transform(deviations, lambda x: F.try_multiply(x, x).cast("decimal(38,0)"))
        deviation = F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda s, x: F.try_add(s, x).cast("decimal(38,0)")).try_cast("bigint")

    def projected(slab: DataFrame, rows: int) -> DataFrame:
        blocks = _blocks(slab, rows, _centred(model.n, model.sums, model.exact_long), d)
        product = _times(blocks, model.projection, spark.sparkContext).toIndexedRowMatrix()
        z = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)  # a DataFrame, not an RDD through Python
        z = z.select("index", vector_to_array("vector").alias("z"))
        return slab.select("index", "id", deviation.alias("deviation")).join(z, "index").drop("index")

    found = reduce(DataFrame.unionByName, [projected(*slab) for slab in _slabs(vectors)])
    total, kept = model.values.sum(), model.vectors.shape[1]
    explained = F.array(*[F.lit(float(e / total) if total > 0 else None).cast("double") for e in model.values[:kept]])
    spread = F.array(*[F.lit(bool(s)) for s in model.spread])
    return found.select("id", "deviation", F.posexplode("z").alias("place", "value")).select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.when(F.get(spread, F.col("place")), F.col("value")).alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def whitened_embeddings(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out; entries beyond 2**40 are held to
    that. Components are fitted on each distinct vector of whole numbers once, and every row is projected, repeated
    rows and rows without an id too. Vectors of several lengths are an error. Vectors without entries, and a
    table without vectors, give no rows. A component without variance (all vectors alike, or fewer than
    dimensions) has null ``whitened`` values and takes no part in ``identity_error``, which is null if there is no
    other; ``explained`` is null if nothing varies. ``deviation`` is null where a long cannot hold it.
    """
    vectors = whole_vectors(rows, id_col, vector_col)
    model = fit_whitening(vectors, components)
    if model is None:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema)
    return whiten(vectors, model).withColumnRenamed("id", "vec_id")
