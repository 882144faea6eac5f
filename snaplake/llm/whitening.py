"""Whitening of integer-scaled vectors from an exact covariance (polarisation).

A vector's entries become whole numbers, so sums over any number of rows in
any order are exact.  Over the distinct vectors, the squared centred values of
every dimension and of every sum of two dimensions are aggregated; by the
polarisation identity, half of what the square of a sum has over the squares
of its parts is the cross covariance.  The matrix is put together from these
numbers on the driver, whose part grows with the square of the dimension and
not with the rows, and goes to ``eigh``.

Partial sums are whole numbers of any size, cut into limbs of ``LIMB`` bits,
and Spark adds the limbs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise

SCALE = 256
COMPONENTS = 4
#: Bits of a limb: a long holds the sum of 2**22 of them and more.
LIMB = 40
#: Rows that are squared in one go.
BLOCK = 1024
_LONG = 1 << 63


def scaled(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of each entry as long."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vec: Column, scale: int = SCALE) -> Column:
    """Vectors with entries, all of them finite numbers whose scaled value is a long."""
    def fits(c: Column) -> Column:
        x = c.cast("double") * F.lit(float(scale))
        return F.coalesce(~F.isnan(x) & (x >= F.lit(float(-_LONG))) & (x < F.lit(float(_LONG))), F.lit(False))
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, fits), F.lit(False))


def square_sums(u: np.ndarray) -> np.ndarray:
    """Exact sums of squares down each column of whole numbers, as Python integers."""
    if not u.size:
        return np.zeros(u.shape[1], object)
    if u.dtype != object:
        top = max(int(u.max()), -int(u.min()))
        if top * top * len(u) < _LONG:
            return (u * u).sum(0).astype(object)
        bits = (top.bit_length() + 1) // 2
        if (1 << 2 * bits) * 2 * len(u) < _LONG:  # u = high * 2**bits + low
            high, low = u >> bits, u & ((1 << bits) - 1)
            squares = [(a * b).sum(0).astype(object) for a, b in ((high, high), (high, low), (low, low))]
            return squares[0] * (1 << 2 * bits) + squares[1] * (2 << bits) + squares[2]
    u = u.astype(object)
    return (u * u).sum(0)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - total, exact: as int64 where sums of two such values fit, else as Python integers."""
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    wide = n * top + max([abs(int(t)) for t in total], default=0)
    if wide < 1 << 61:
        return x * np.int64(n) - total.astype(np.int64)
    return x.astype(object) * n - total


def polarised(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Sums of squares of centred values: for each dimension i, then of the sums of i with each later one."""
    d = len(total)
    sums = np.zeros(d * (d + 1) // 2, object)
    for low in range(0, len(x), BLOCK):
        y = centred(x[low:low + BLOCK], n, total)
        at = 0
        for i in range(d):
            pair = y[:, i:i + 1] + y[:, i:]
            pair[:, 0] = y[:, i]
            sums[at:at + d - i] += square_sums(pair)
            at += d - i
    return sums


def covariance(sums: list[int], d: int, n: int) -> np.ndarray:
    """The covariance matrix, each entry rounded once, from the sums of :func:`polarised`."""
    place = iter(sums)
    square = [[next(place) for _ in range(i, d)] for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = square[i][0] / n ** 3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (square[i][j - i] - square[i][0] - square[j][0]) / (2 * n ** 3)
    return v


@dataclass
class Whitening:
    """What was fitted: number of distinct vectors, their exact sums, eigenvalues and unit eigenvectors (columns)."""

    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def kept(self) -> np.ndarray:
        """Components with variance beyond rounding."""
        least = len(self.total) * np.finfo(float).eps * self.values[0] if len(self.values) else 0.0
        return (self.values > least) & (self.values > 0)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of scaled vectors; NaN for a component without variance."""
        unit = np.where(self.kept, 1 / np.sqrt(np.where(self.kept, self.values, 1)), np.nan)
        return (centred(x, self.n, self.total) / self.n).astype(float) @ self.vectors * unit


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on a table of distinct vectors (column ``x``, arrays of ``d`` longs); None without rows.

    To the driver come d sums and about d * d / 2 sums of squares in limbs.
    """
    n = fit.count()
    if not n:
        return None
    rows = fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    total = np.zeros(d, object)
    for r in rows:
        total[r["pos"]] = int(r["s"])

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(d * (d + 1) // 2, object)
        for batch in batches:
            sums += polarised(_matrix(batch.column("x"), d), n, total)
        limbs = [(place, k, limb) for place, value in enumerate(sums.tolist()) if value
                 for k, limb in enumerate(_limbs(value))]
        for low in range(0, len(limbs), 1 << 16):
            place, k, limb = zip(*limbs[low:low + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(k, pa.int32()),
                                              pa.array(limb, pa.int64())], ["place", "k", "limb"])

    parts = fit.select("x").mapInArrow(squares, "place long, k int, limb long")
    sums = [0] * (d * (d + 1) // 2)
    for r in parts.groupBy("place", "k").agg(F.sum("limb").alias("limb")).collect():
        sums[r["place"]] += r["limb"] << (LIMB * r["k"])
    v = covariance(sums, d, n)
    values, vectors = np.linalg.eigh(v)
    held = min(components, d)
    return Whitening(n, total, values[::-1][:held], vectors[:, ::-1][:, :held], float(np.trace(v)))


def _limbs(value: int) -> Iterator[int]:
    while value:
        yield value & ((1 << LIMB) - 1)
        value >>= LIMB


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, d = len(w.values), len(w.total)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = w.apply(_matrix(batch.column("x"), d))
            first, second = first + z.sum(0), second + z.T @ z
        held = [*first.tolist(), *second.ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), pa.array(held)], ["place", "s"])

    found = fit.select("x").mapInArrow(moments, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()
    held = np.zeros(k + k * k)
    for r in found:
        held[r["place"]] = r["s"]
    mean = held[:k] / w.n
    cov = held[k:].reshape(k, k) / w.n - np.outer(mean, mean)
    kept = w.kept
    return float(np.abs((cov - np.eye(k))[np.ix_(kept, kept)]).max()) if kept.any() else 0.0


def whiten(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), one row per vector and component.

    A vector that is NULL or empty, or holds an entry that is NULL, not finite
    or beyond a long once scaled, is left out; so are vectors of another
    length than the commonest one (of equally common ones the smallest).
    Repeated rows keep all their rows but count once in the fit; NULL keys are
    keys like any other.  Other columns are not read.

    ``deviation`` is the exact sum of (n * x - total)**2, NULL beyond a long.
    A component without variance (all vectors in a subspace, one vector)
    has a NULL ``whitened`` and does not count in ``identity_error``;
    ``explained`` is NULL if no dimension varies.  Components are at most as
    many as dimensions.  An empty table gives no rows.
    """
    schema = f"{'`' + key.replace('`', '``') + '`'} {vectors.schema[key].dataType.simpleString()}, component int, n long, " \
             "deviation long, whitened double, explained double, identity_error double"
    rows = materialise(vectors.filter(usable(col(vec), scale)).select(col(key).alias("key"), scaled(col(vec), scale).alias("x")),
                       "whitening-rows")
    size = F.size("x")
    common = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d = common["d"]
    rows = rows.filter(size == d)
    fit = materialise(rows.select("x").distinct(), "whitening-fit")
    w = fit_whitening(fit, d, components)
    error, k = identity_error(fit, w), len(w.values)
    explained = [float(e / w.trace) if w.trace > 0 else None for e in w.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            deviation = [s if s < _LONG else None for s in square_sums(centred(x, w.n, w.total).T).tolist()]
            z = w.apply(x).ravel()
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(z, mask=np.isnan(z)), pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
