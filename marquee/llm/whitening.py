"""Whitening of embeddings with Spark MLlib's BlockMatrix.

1. Entries become integers, so the distinct vectors (the fit list), their number
   n and their sums S per dimension are exact.
2. Centred rows are indexed into blocks of a distributed BlockMatrix: a task
   fills blocks one after another, and partitions' block counts give every block
   its place. Blocks are padded with zero rows, which add nothing.
3. transpose x matrix gives the scatter; the block sums are split over the middle
   dimension, so that a task multiplies single blocks. Its eigenvectors come from
   a local ``eigh`` of the d x d result.
4. matrix x (eigenvectors over the roots of their eigenvalues) projects the rows:
   of the fit list, whose covariance is measured against the identity, and of
   all rows, copies included.

BlockMatrix.multiply lists the places of a matrix's blocks on the driver and
deals tall products to about the root of the number of blocks, so a matrix has at most
SLICE blocks; larger tables are a sequence of matrices whose scatters are added
and whose projections are united. All blocks are written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, written
from .vectors import integer_vectors

BLOCK_VALUES = 1 << 17  # of a block: 1 MB
SLICE = 4096  # blocks of one BlockMatrix
LARGEST = float(1 << 50)  # of an integer entry
FLAT = 1e-12  # share of the largest variance below which a direction can't be whitened in doubles


def _centre(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """x - S/n, and per row the sum of (n x - S)^2, for S = n whole + rest; null
    where that sum doesn't fit a long."""
    y = x - whole
    if not len(y):
        return y.astype(np.float64), []
    if (int(np.abs(y).max()) + 1) * n < np.sqrt(2.0**62 / y.shape[1]):
        sums = np.square(n * y - rest).sum(axis=1).tolist()
    else:
        sums = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in y.tolist()]
    return y - rest / n, [s if s < 1 << 63 else None for s in sums]


def _blocked(rows: int, d: int, n: int, whole: np.ndarray, rest: np.ndarray):
    """Batches of (id, missing, x) to blocks; a missing id becomes null."""

    def closed(part: int, place: int, held: list) -> pd.DataFrame:
        ids, sums, y = [np.concatenate([h[k] for h in held]) for k in range(3)]
        block = np.zeros((rows, d))
        block[: len(y)] = y
        return pd.DataFrame({"part": [part], "place": [place], "ids": [ids], "deviations": [sums], "values": [block.ravel()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place, held, size = TaskContext.get().partitionId(), 0, [], 0
        for pdf in batches:
            y, sums = _centre(np.stack(pdf["x"].to_numpy()), n, whole, rest) if len(pdf) else (np.empty((0, d)), [])
            ids = np.where(pdf["missing"], None, pdf["id"].astype(object))
            sums = np.array(sums, dtype=object)
            while len(y):
                k = min(rows - size, len(y))
                held.append((ids[:k], sums[:k], y[:k]))
                ids, sums, y, size = ids[k:], sums[k:], y[k:], size + k
                if size == rows:
                    yield closed(part, place, held)
                    place, held, size = place + 1, [], 0
        if held:
            yield closed(part, place, held)

    return run


class Blocks:
    """Centred rows as a written table of blocks, and as BlockMatrices."""

    def __init__(self, table: DataFrame, d: int, n: int, sums: list[int], key: str | None):
        spark = table.sparkSession
        self.spark, self.d = spark, d
        self.rows = max(1, BLOCK_VALUES // d)
        whole = np.array([s // n for s in sums], dtype=np.int64)
        rest = np.array([s % n for s in sums], dtype=np.int64)
        full = max(1, table.count() // (2 * self.rows))  # partitions of two blocks at least
        id = F.col(f"`{key}`") if key else F.lit(0).cast("long")
        # a null in a column of longs would make it one of doubles in pandas
        named = table.select(F.coalesce(id, F.lit(0)).alias("id"), id.isNull().alias("missing"), "x")
        raw = named.coalesce(full).mapInPandas(
            _blocked(self.rows, d, n, whole, rest),
            "part int, place int, ids array<long>, deviations array<long>, values array<double>",
        )
        matrix = F.struct(
            F.lit(1).cast("byte").alias("type"),
            F.lit(self.rows).alias("numRows"),
            F.lit(d).alias("numCols"),
            F.lit(None).cast("array<int>").alias("colPtrs"),
            F.lit(None).cast("array<int>").alias("rowIndices"),
            F.col("values"),
            F.lit(True).alias("isTransposed"),
        )
        table = raw.select("part", "place", "ids", "deviations", matrix.alias("subMatrix"))
        self.path = stored(table, "whitening-blocks")
        self.stored = spark.read.schema(table.schema).parquet(self.path)
        counts = sorted((r["part"], r["n"]) for r in self.stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
        first = [0, *accumulate(n for _, n in counts)]
        self.n = first.pop()
        self.first = spark.createDataFrame([(p, f) for (p, _), f in zip(counts, first)], "part int, first long")

    def _numbered(self, df: DataFrame) -> DataFrame:
        return df.join(self.first, "part").withColumn("block", F.col("first") + F.col("place"))

    def ids(self) -> DataFrame:
        return self._numbered(self.stored.select("part", "place", "ids", "deviations")).select("block", "ids", "deviations")

    def matrices(self) -> Iterator[tuple[int, BlockMatrix]]:
        """(first block, matrix) of each slice."""
        kinds = {f.name: f for f in self.stored.schema}
        kind = T.StructType([kinds["part"], kinds["place"], T.StructField("subMatrix", MatrixUDT())])
        table = self._numbered(self.spark.read.schema(kind).parquet(self.path))
        for first in range(0, self.n, SLICE):
            size = min(SLICE, self.n - first)
            own = table.filter(F.col("block").between(first, first + size - 1)).select(
                F.struct((F.col("block") - first).alias("i"), F.lit(0).cast("long").alias("j")), "subMatrix"
            )
            made = callMLlibFunc("createBlockMatrix", own, self.rows, self.d, size * self.rows, self.d)
            yield first, BlockMatrix(made, self.rows, self.d)


def _gram(matrix: BlockMatrix) -> np.ndarray:
    """transpose x matrix, each block in a product of its own."""
    left = matrix.transpose()
    other = matrix._java_matrix_wrapper._java_model
    # the number of splits of the middle dimension isn't in the Python signature
    made = left._java_matrix_wrapper.call("multiply", other, max(1, matrix.numRows() // matrix.rowsPerBlock))
    return BlockMatrix(made, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, directions: np.ndarray) -> BlockMatrix:
    d, k = directions.shape
    block = ((0, 0), DenseMatrix(d, k, directions.ravel(order="F")))
    spark = SparkSession.active()
    return matrix.multiply(BlockMatrix(spark.sparkContext.parallelize([block], 1), d, k))


def _directions(variances: np.ndarray, vectors: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors by falling eigenvalue, over the eigenvalues' roots, as columns
    (the largest entry of each is positive), and these eigenvalues."""
    order = [i for i in np.argsort(-variances, kind="stable") if variances[i] > FLAT * variances.max()][:components]
    v = vectors[:, order]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(len(order))])
    return v / np.sqrt(variances[order]), variances[order]


def whitened(
    table: DataFrame, *, components: int = 16, scale: int = 64, shift: int = 1_000_000, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``key``, component (int, from 1), n, deviation, whitened, explained,
    identity_error: a row for each usable row of ``table`` and component.

    x = floor(scale * c) + shift for every entry c. n distinct vectors with sums S
    per dimension are fitted; deviation is the sum of (n x - S)^2, exact;
    whitened is x - S/n projected on the component, over the root of its
    variance; explained is its share of all variance; identity_error the largest
    entry of |covariance of the fitted vectors' whitened rows - identity|.

    Cases: rows with a null vector or a null or non-finite entry are left out,
    and with them entries that don't fit (|x| of 2^50 or more) and vectors of
    another than the commonest length; a null key stays null; rows that repeat a
    key or a vector are each returned; a deviation that doesn't fit a long is
    null; directions without variance have no component, so a table of one
    distinct vector, and an empty one, give no rows; other columns are ignored.
    The result is read from written tables."""
    spark = table.sparkSession
    usable, d = integer_vectors(table, key=key, vector=vector, scale=scale, shift=shift, below=LARGEST)
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = written(usable, "whitening-rows")
    fit = written(rows.select("x").distinct(), "whitening-fit")
    n = fit.count()
    if d == 0 or n < 2:
        return spark.createDataFrame([], schema)
    # high and low parts, so that no sum overflows
    parts = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.shiftright("c", 28)).alias("high"), F.sum(F.col("c").bitwiseAND(F.lit((1 << 28) - 1))).alias("low")
    )
    sums = [(r["high"] << 28) + r["low"] for r in sorted(parts.collect(), key=lambda r: r["at"])]

    fitted = Blocks(fit, d, n, sums, None)
    covariance = sum(_gram(m) for _, m in fitted.matrices()) / n
    variances, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    directions, kept = _directions(variances, vectors, components)
    k = directions.shape[1]
    explained = (kept / np.trace(covariance)).tolist()
    measured = sum(_gram(_projected(m, directions)) for _, m in fitted.matrices()) / n
    error = float(np.abs(measured - np.eye(k)).max())

    every = Blocks(rows, d, n, sums, key)
    out = None
    for first, matrix in every.matrices():
        made = callMLlibFunc("getMatrixBlocks", _projected(matrix, directions)._java_matrix_wrapper._java_model)
        made = made.select((F.col("_1._1") + F.lit(first).cast("long")).alias("block"), F.col("_2").alias("subMatrix"))
        out = made if out is None else out.union(made)
    path = stored(out, "whitening-projected")
    plain = T.StructType([T.StructField("block", T.LongType()), T.StructField("subMatrix", MatrixUDT.sqlType())])
    blocks = spark.read.schema(plain).parquet(path).select("block", "subMatrix.values", "subMatrix.isTransposed")

    def row(v, r):
        at = lambda c: F.when(F.col("isTransposed"), r * k + c).otherwise(c * every.rows + r)
        values = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: F.get("values", at(c)))
        return F.struct(v["ids"].alias(key), v["deviations"].alias("deviation"), values.alias("z"))

    each = blocks.join(every.ids(), "block").select(F.inline(F.transform(F.arrays_zip("ids", "deviations"), row)))
    shares = F.array(*[F.lit(e) for e in explained])
    return each.select(key, "deviation", F.posexplode("z").alias("at", "whitened")).select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
