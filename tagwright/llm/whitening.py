"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Components become whole numbers, so the scatter of the distinct vectors is a
matrix of integers, summed without rounding: every task sums its rows, Spark
sums the tasks' entries. Its characteristic polynomial is found modulo primes
that are dealt over tasks, the largest roots are isolated to 128 bits, and
inverse iteration at a root gives its component (``char_poly.py``). What the
driver holds is the matrix and the polynomial, whose size is that of the
vectors, whatever the number of rows.

Vectors that are null or hold null or non-finite components take no part.
Missing components at the end of shorter vectors count as zero. Each distinct
vector is fitted once, repeated rows are each whitened, null keys stay, other
columns are ignored. Only components with a positive variance are there: none
for an empty table or one distinct vector, whose result is empty. Equal
variances give any orthonormal components of their space. A deviation beyond 64
bits is null.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagwright.llm import char_poly
from tagwright.llm.top_k import whole_weights
from tagwright.workspace import materialize

#: the largest whole number whose double is exact, and the largest of 64 bits
_EXACT, _LONG = 1 << 53, (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """The fit: rows of ``components`` are unit vectors, ``roots`` the eigenvalues of ``n * n`` times the covariance."""

    n: int
    sums: list[int]
    trace: int
    roots: list[float]
    components: list[list[float]]
    identity_error: float | None = None

    @property
    def explained(self) -> list[float]:
        return [r / self.trace for r in self.roots]


def _padded(vector: Column, width: int) -> Column:
    return F.concat(vector, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector)))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _products(x: np.ndarray) -> np.ndarray:
    """The exact sums of products of the columns, as Python's integers."""
    largest = max(-int(x.min()), int(x.max()), 1) if x.size else 1
    step = _EXACT // (largest * largest)
    if not step:
        return x.astype(object).T @ x.astype(object)
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), step):
        part = x[at : at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def scatter(vectors: DataFrame, column: str, width: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and sums of products, exactly; every row adds a one in front."""
    upper = np.triu_indices(width + 1)
    schema = "i int, j int, total decimal(38,0)"

    def run(batches):
        total = np.zeros((width + 1, width + 1), object)
        for batch in batches:
            x = _rows(batch.column(0), width)
            total = total + _products(np.column_stack([np.ones(len(x), np.int64), x]))
        yield pa.record_batch([
            pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()),
            pa.array([Decimal(int(t)) for t in total[upper]], pa.decimal128(38, 0)),
        ], names=["i", "j", "total"])

    summed = vectors.select(column).mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("total").alias("total"))
    whole = np.zeros((width + 1, width + 1), object)
    for row in summed.collect():
        whole[row["i"], row["j"]] = whole[row["j"], row["i"]] = int(row["total"])
    return int(whole[0, 0]), [int(s) for s in whole[0, 1:]], whole[1:, 1:]


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """``det(xI - matrix)`` of an integer matrix without negative eigenvalues; primes are dealt over tasks."""
    size = len(matrix)
    bits = char_poly.coefficient_bits(int(np.trace(matrix)), size) + 1
    # one prime more than needed checks the others
    primes = char_poly.primes_below(1 << 31, 2 + bits // 30)
    entries = [[str(int(x)) for x in row] for row in matrix]

    def run(batches):
        own = np.array([[int(x) for x in row] for row in entries], object)
        for batch in batches:
            found = batch.column(0).to_pylist()
            yield pa.record_batch([
                pa.array(found, pa.int64()), pa.array([char_poly.polynomial_modulo(own, p) for p in found], pa.list_(pa.int64())),
            ], names=["prime", "rest"])

    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(
        min(len(primes), spark.sparkContext.defaultParallelism))
    found = {r["prime"]: r["rest"] for r in dealt.mapInArrow(run, "prime long, rest array<long>").collect()}
    check = primes[-1]
    rest = found.pop(check)
    coefficients = char_poly.combine(found)
    if [c % check for c in coefficients] != rest:
        raise ArithmeticError("the characteristic polynomial does not agree with its check prime")
    return coefficients


def _project(batch: pa.Array, width: int, fit: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Rows times ``n`` less the sums, exact, and their whitened values."""
    x, sums = _rows(batch, width), np.array(fit.sums, object)
    largest = fit.n * (max(-int(x.min()), int(x.max())) if x.size else 0) + max(map(abs, fit.sums), default=0)
    far = x * fit.n - sums.astype(np.int64) if largest < _LONG else x.astype(object) * fit.n - sums
    weights = np.array(fit.components) / np.sqrt(np.array(fit.roots))[:, None]
    return far, far.astype(np.float64) @ weights.T


def fit_whitening(vectors: DataFrame, column: str = "vector", components: int = 4) -> Whitening:
    """Fit on the distinct vectors of ``column`` (arrays of whole numbers; null takes no part)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(column).alias("x")).where(F.col("x").isNotNull())
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return Whitening(rows.limit(1).count(), [], 0, [], [])
    fitted = materialize(rows.select(_padded(F.col("x"), width).alias("x")).distinct(), "whitening")
    n, sums, products = scatter(fitted, "x", width)
    matrix = products * n - np.outer(np.array(sums, object), np.array(sums, object))
    trace = int(np.trace(matrix))
    if not trace:
        return Whitening(n, sums, 0, [], [])
    roots = char_poly.Roots(characteristic_polynomial(spark, matrix))
    bounds = [roots.largest(k) for k in range(1, min(components, roots.positive) + 1)]
    values, found = [], []
    for low, high in dict.fromkeys(bounds):
        at = (low + high) / 2
        count = bounds.count((low, high))
        found.extend(char_poly.null_vectors(matrix, at, count).tolist())
        values.extend([float(at)] * count)
    fit = Whitening(n, sums, trace, values, found)
    return Whitening(n, sums, trace, values, found, _identity_error(fitted, width, fit))


def _identity_error(fitted: DataFrame, width: int, fit: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    names = [f"c{i}" for i in range(len(fit.roots))]

    def run(batches):
        for batch in batches:
            _, white = _project(batch.column(0), width, fit)
            yield pa.record_batch([pa.array(c) for c in white.T], names=names)

    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    white = fitted.mapInArrow(run, ", ".join(f"{n} double" for n in names))
    row = white.agg(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, row))


def whiten(vectors: DataFrame, fit: Whitening, key: str = "vec_id", column: str = "vector") -> DataFrame:
    """A row per vector and component: ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    width, k = len(fit.sums), len(fit.roots)
    schema = T.StructType([vectors.schema[key], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double"
    ).fields])
    explained = np.array(fit.explained)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            far, white = _project(batch.column(1), width, fit)
            m = len(far)
            if far.dtype != object and width * int(np.abs(far).max(initial=0)) ** 2 <= _LONG:
                deviation = (far * far).sum(axis=1).tolist()
            else:
                deviation = [d if d <= _LONG else None for d in (far.astype(object) ** 2).sum(axis=1).tolist()]
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)).cast(arrow.field(0).type), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, fit.n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(each)),
                pa.array(white.reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, fit.identity_error)),
            ], schema=arrow)

    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = vectors.where(F.col(column).isNotNull()).select(key, _padded(F.col(column), width).alias("x"))
    return rows.mapInArrow(run, schema)


def whole_vectors(vector: Column, scale: float = 256.0) -> Column:
    """Components as whole numbers: floor(scale * c); null where the vector takes no part."""
    return whole_weights(vector, scale)
