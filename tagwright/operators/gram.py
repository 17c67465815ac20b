"""Gram matrices of vector columns: one pass over the rows, sparse vectors stay sparse.

The matrix is that of the columns ``1, label, features``, so counts, sums,
squares and products come from the same pass. It is cut into stripes of columns
that fit a task's memory. Every task adds up its rows' part of a stripe; a
stripe's rows are then added over tasks, one row at a time. Where the whole
matrix is one stripe, vectors are read in place; wider ones are dealt once per
stripe.

Columns that are non-zero in half of a few rows at the start are taken less
their mean there: squares of far-away values would lose digits. The others are
mostly zero, and so near their origin already. Neither choice changes results.

Rows without label or vector take no part. Sums over parts of the rows (folds,
time windows) come from the same pass: ``by`` keeps a matrix per part, and any
choice of parts is a sum of theirs.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.workspace import materialize

#: bytes of a stripe in one task, and of a matrix that the driver takes
STRIPE_BYTES, DRIVER_BYTES = 64 << 20, 256 << 20
#: rows looked at to choose origins; values of a batch that are filled up at once; products of a batch made at once
_LOOK, _FILL, _PAIRS = 200, 2_000_000, 2_000_000
#: a filled-up product costs about this share of one that is looked up
_FILLED_COST = 1 / 60


def _sparse(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of the entries of vectors, dense or sparse."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values, indices = column.field("values"), column.field("indices")
    n = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(kind)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    place[(kind == 0)[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    found = values.flatten().to_numpy(zero_copy_only=False)
    some = found != 0
    return row[some], place[some], found[some]


class _Stripe:
    """Columns ``first`` to ``last`` of the matrix, added up over batches."""

    def __init__(self, first: int, last: int, width: int, origin: np.ndarray, filled: np.ndarray):
        self.first, self.last, self.width = first, last, width
        #: columns that are kept as full arrays, and where; the others are sparse
        self.filled, self.origin = np.flatnonzero(filled), origin
        self.place = np.full(width, -1)
        self.place[self.filled] = np.arange(len(self.filled))
        self.mine = self.filled[(self.filled >= first) & (self.filled < last)]
        self.full = np.zeros((len(self.mine), len(self.filled)))
        self.mixed = np.zeros((len(self.mine), width))
        self.turned = np.zeros((last - first, len(self.filled)))
        self.both = np.zeros((last - first, width))

    def add(self, label: np.ndarray, column: pa.Array) -> None:
        row, at, value = _sparse(column)
        at = at + 2
        step = max(1, _FILL // self.width)
        bounds = np.searchsorted(row, np.arange(0, len(label) + step, step))
        for k, first in enumerate(range(0, len(label), step)):
            some = slice(bounds[k], bounds[k + 1])
            self._add(label[first : first + step], row[some] - first, at[some], value[some])

    def _add(self, label, row, at, value) -> None:
        rows, a, b = len(label), self.first, self.last
        full = np.zeros((rows, len(self.filled)))
        full[:, self.place[0]], full[:, self.place[1]] = 1, label
        inside = self.place[at] >= 0
        full[row[inside], self.place[at[inside]]] = value[inside]
        full -= self.origin[self.filled]
        own = full[:, self.place[self.mine]]
        self.full += own.T @ full
        row, at, value = row[~inside], at[~inside], value[~inside]
        wide = np.zeros((rows, self.width))
        wide[row, at] = value
        if len(self.mine):
            self.mixed += own.T @ wide
        self.turned += wide[:, a:b].T @ full
        count = np.bincount(row, minlength=rows)
        if float((count.astype(float) ** 2).sum()) > _FILLED_COST * rows * self.width * self.width:
            self.both += wide[:, a:b].T @ wide
        else:
            self._pairs(count, at, value)

    def _pairs(self, count, at, value) -> None:
        """Products of all pairs of a row's sparse entries whose first lies in the stripe."""
        ends = np.cumsum(count)
        left = np.flatnonzero((at >= self.first) & (at < self.last))
        of = np.searchsorted(ends, left, side="right")
        size = count[of]
        total = np.cumsum(size)
        flat = self.both.reshape(-1)
        start = 0
        while start < len(left):
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + _PAIRS, side="right")))
            n, mine = size[start:stop], left[start:stop]
            first = np.repeat(mine, n)
            second = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat((ends - count)[of[start:stop]], n)
            np.add.at(flat, (at[first] - self.first) * self.width + at[second], value[first] * value[second])
            start = stop

    def rows(self, part: int) -> pa.RecordBatch:
        out = self.both
        out[:, self.filled] += self.turned
        out[self.mine - self.first] += self.mixed
        out[np.ix_(self.mine - self.first, self.filled)] += self.full
        return pa.record_batch([
            pa.array(np.full(self.last - self.first, part), pa.int32()), pa.array(np.arange(self.first, self.last), pa.int32()),
            pa.ListArray.from_arrays(np.arange(0, out.size + 1, self.width, dtype=np.int32), pa.array(out.reshape(-1))),
        ], names=["part", "i", "products"])


_ROWS = "part int, i int, products array<double>"


def _added(batches):
    """Rows of the same part and number, which come one after the other, added up."""
    last, total = None, None

    def out():
        return pa.record_batch([
            pa.array([last[0]], pa.int32()), pa.array([last[1]], pa.int32()), pa.array([total], pa.list_(pa.float64())),
        ], names=["part", "i", "products"])

    for batch in batches:
        for k in range(batch.num_rows):
            at, row = (batch.column(0)[k].as_py(), batch.column(1)[k].as_py()), batch.column(2)[k].values.to_numpy()
            if at != last:
                if last is not None:
                    yield out()
                last, total = at, np.zeros(len(row))
            total = total + row
    if last is not None:
        yield out()


@dataclass(frozen=True)
class Gram:
    """``table`` has a row ``part, i, products`` per part and column: a 1, the label, then the features, all less ``origin``."""

    table: DataFrame
    origin: np.ndarray
    #: what the driver may hold of the matrix
    driver_bytes: int = DRIVER_BYTES
    #: the parts whose sum this is; None: all
    parts: tuple[int, ...] | None = None

    @property
    def width(self) -> int:
        return len(self.origin)

    @property
    def fits(self) -> bool:
        """Whether the matrix is small enough, by its width, to be taken to the driver."""
        return 8 * self.width * self.width <= self.driver_bytes

    def of(self, *parts: int) -> Gram:
        return replace(self, parts=parts)

    @property
    def rows(self) -> DataFrame:
        return self.table if self.parts is None else self.table.where(F.col("part").isin(*self.parts))

    def matrix(self) -> np.ndarray:
        out = np.zeros((self.width, self.width))
        found = self.rows.toArrow()
        for batch in found.to_batches():
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, self.width)
            np.add.at(out, batch.column(1).to_numpy(), values)
        return out

    def column(self, i: int) -> np.ndarray:
        found = self.rows.where(F.col("i") == i).toArrow()["products"].to_pylist()
        return np.sum([np.array(x) for x in found], axis=0) if found else np.zeros(self.width)

    def diagonal(self) -> np.ndarray:
        found = self.rows.select("i", F.get("products", F.col("i")).alias("p")).groupBy("i").agg(F.sum("p").alias("p")).toArrow()
        out = np.zeros(self.width)
        out[found["i"].to_numpy()] = found["p"].to_numpy()
        return out

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The matrix times a vector, where its rows lie."""
        def run(batches):
            for batch in batches:
                rows = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.record_batch([batch.column(1), pa.array(rows @ vector)], names=["i", "v"])

        found = self.rows.mapInArrow(run, "i int, v double").toArrow()
        out = np.zeros(self.width)
        np.add.at(out, found["i"].to_numpy(), found["v"].to_numpy())
        return out


def _origin(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Origins of all columns, and which columns are filled up: the label and what is mostly non-zero at the start."""
    few = df.limit(_LOOK).toArrow()
    if not few.num_rows:
        raise ValueError("no row with a label and a vector")
    row, at, value = _sparse(few["v"])
    width, n = int(df.first()["v"].size), few.num_rows
    filled = np.bincount(at, minlength=width) * 2 >= n
    means = np.bincount(at, value, minlength=width) / n
    label = float(np.mean(few["y"].to_numpy()))
    return np.concatenate([[0.0, label], np.where(filled, means, 0.0)]), np.concatenate([[True, True], filled])


def gram(
    df: DataFrame, features: str = "features", label: str | None = "label", by: str | None = None,
    stripe_bytes: int = STRIPE_BYTES, driver_bytes: int = DRIVER_BYTES, centred: bool = True,
) -> Gram:
    """The Gram matrix of a vector column and a label (none: zeros), kept apart by the whole number ``by``.

    Without ``centred`` all origins are 0, so entries are plain sums of products.
    """
    y = F.col(label).cast("double") if label else F.lit(0.0)
    part = F.col(by).cast("int") if by else F.lit(0)
    rows = df.select(y.alias("y"), F.col(features).alias("v"), part.alias("part")).where("y IS NOT NULL AND v IS NOT NULL")
    origin, filled = _origin(rows)
    origin = origin if centred else np.zeros(len(origin))
    width = len(origin)
    height = max(1, min(width, stripe_bytes // (8 * width)))
    stripes = -(-width // height)

    def run(batches):
        stripe, at = None, None
        for batch in batches:
            codes = batch.column(2).to_numpy().astype(np.int64) + (batch.column(3).to_numpy().astype(np.int64) << 32)
            for code in np.unique(codes).tolist():
                if code != at:
                    if stripe is not None:
                        yield stripe.rows((at + (1 << 31)) % (1 << 32) - (1 << 31))
                    first = ((code + (1 << 31)) >> 32) * height
                    stripe, at = _Stripe(first, min(width, first + height), width, origin, filled), code
                some = batch if (codes == code).all() else batch.filter(pa.array(codes == code))
                stripe.add(some.column(0).to_numpy(), some.column(1))
        if stripe is not None:
            yield stripe.rows((at + (1 << 31)) % (1 << 32) - (1 << 31))

    if stripes == 1:
        dealt = rows.withColumn("stripe", F.lit(0))
    else:
        # the rows of a stripe are spread by the place they came from
        dealt = rows.withColumn("place", F.monotonically_increasing_id()).withColumn(
            "stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
        dealt = dealt.repartition("stripe", F.pmod("place", F.lit(64))).drop("place")
    if stripes > 1 or by:
        # a task adds up one stripe of one part at a time
        dealt = dealt.sortWithinPartitions("stripe", "part")
    found = dealt.mapInArrow(run, _ROWS)
    added = found.repartition("part", "i").sortWithinPartitions("part", "i").mapInArrow(_added, _ROWS)
    return Gram(materialize(added, "gram"), origin, driver_bytes)


@dataclass(frozen=True)
class Moments:
    """Means, and the centred products of features and label as functions of a vector of features."""

    n: float
    mean: np.ndarray
    label_mean: float
    #: centred products with the label, and of each feature with itself
    with_label: np.ndarray
    squares: np.ndarray
    gram: Gram
    #: the centred products of features with each other, where the driver holds them
    matrix: np.ndarray | None

    def times(self, w: np.ndarray) -> np.ndarray:
        if self.matrix is not None:
            return self.matrix @ w
        sums = self.n * (self.mean - self.gram.origin[2:])
        return self.gram.times(np.concatenate([[0.0, 0.0], w]))[2:] - sums * (sums @ w) / self.n


def moments(g: Gram) -> Moments:
    matrix = None
    if g.fits:
        whole = g.matrix()
        sums, label, squares = whole[0], whole[1], np.diag(whole).copy()
        if sums[0]:
            matrix = whole[2:, 2:] - np.outer(sums[2:], sums[2:]) / sums[0]
    else:
        sums, label, squares = g.column(0), g.column(1), g.diagonal()
    n = sums[0]
    if not n:
        raise ValueError("no row with a label and a vector")
    return Moments(
        n, g.origin[2:] + sums[2:] / n, g.origin[1] + sums[1] / n, label[2:] - sums[1] * sums[2:] / n,
        np.maximum(squares[2:] - sums[2:] ** 2 / n, 0.0), g, matrix,
    )


def solve_ridge(m: Moments, alpha: float, tolerance: float = 1e-13) -> np.ndarray:
    """Coefficients that minimise ``|y - Xw|^2 + alpha |w|^2``, centred.

    Directly where the driver holds the matrix (of least norm without a penalty), else by conjugate gradients on
    its rows.
    """
    if m.matrix is not None:
        if alpha <= 0:
            return np.linalg.lstsq(m.matrix, m.with_label, rcond=None)[0]
        return np.linalg.solve(m.matrix + alpha * np.eye(len(m.matrix)), m.with_label)
    scale = 1 / np.sqrt(m.squares + alpha + (m.squares + alpha == 0))
    w, rest = np.zeros(len(m.mean)), m.with_label * scale
    direction, size = rest, rest @ rest
    enough = tolerance**2 * size
    for _ in range(10 * len(w)):
        if size <= enough:
            break
        step = scale * (m.times(scale * direction) + alpha * scale * direction)
        a = size / (direction @ step)
        w, rest = w + a * direction, rest - a * step
        size, before = rest @ rest, size
        direction = rest + size / before * direction
    return scale * w


def _shrink(x, by):
    return np.sign(x) * np.maximum(np.abs(x) - by, 0.0)


def solve_elastic_net(m: Moments, alpha: float, ratio: float, tolerance: float = 1e-11, rounds: int = 100_000) -> np.ndarray:
    """Coefficients that minimise ``|y - Xw|^2 / 2n + alpha (r |w|_1 + (1 - r)/2 |w|^2)``, centred.

    By coordinate descent where the driver holds the matrix, else by accelerated proximal steps on its rows.
    """
    one, two = alpha * ratio, alpha * (1 - ratio)
    with_label, squares = m.with_label / m.n, m.squares / m.n
    w = np.zeros(len(with_label))
    scale = np.sqrt(squares)
    if m.matrix is not None:
        matrix = m.matrix / m.n
        rest, every = with_label.copy(), np.flatnonzero(squares + two > 0)
        active = every
        for _ in range(rounds):
            moved = 0.0
            for j in active.tolist():
                old = w[j]
                new = float(_shrink(rest[j] + squares[j] * old, one)) / (squares[j] + two)
                if new != old:
                    rest -= matrix[j] * (new - old)
                    w[j] = new
                    moved = max(moved, abs(new - old) * scale[j])
            still = moved <= tolerance * max(1.0, np.abs(w * scale).max(initial=0))
            if still and len(active) == len(every):
                break
            # between rounds over all columns, only those that are not zero move
            active = every if still else np.flatnonzero(w)
        return w
    steepest = np.random.default_rng(0).normal(size=len(w))
    for _ in range(30):
        steepest = m.times(steepest / np.linalg.norm(steepest)) / m.n
    bound = 1.1 * np.linalg.norm(steepest) + two
    at, pace = w, 1.0
    for _ in range(rounds):
        new = _shrink(at - (m.times(at) / m.n - with_label + two * at) / bound, one / bound)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        moved = np.abs((new - w) * scale).max(initial=0)
        if (new - w) @ (at - new) > 0:
            faster, at = 1.0, new
        else:
            at = new + (pace - 1) / faster * (new - w)
        w, pace = new, faster
        if moved <= tolerance * max(1.0, np.abs(w * scale).max(initial=0)):
            break
    return w


def vector_correlations(df: DataFrame, vector: str = "features", stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """``left, right, correlation`` of every ordered pair of a vector's places; null without spread.

    Products are turned into correlations where their rows lie, so the result is as distributed as the matrix.
    """
    g = gram(df, vector, None, stripe_bytes=stripe_bytes)
    m = moments(replace(g, driver_bytes=0))
    n, sums, spread = m.n, m.n * (m.mean - g.origin[2:]), np.sqrt(m.squares)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                i = batch.column(1)[k].as_py() - 2
                row = batch.column(2)[k].values.to_numpy()[2:] - sums[i] * sums / n
                size = spread[i] * spread
                found = np.where(size > 0, row / np.where(size > 0, size, 1), np.nan)
                yield pa.record_batch([
                    pa.array(np.full(len(row), i), pa.int32()), pa.array(np.arange(len(row)), pa.int32()),
                    pa.array(found, mask=size == 0),
                ], names=["left", "right", "correlation"])

    return g.table.where("i >= 2").mapInArrow(run, "left int, right int, correlation double")
