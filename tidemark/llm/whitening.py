"""Whitening of embeddings by their leading principal components, found with FEAST.

Spark makes the sums over all vectors in three scans: n and the exact sums per
dimension; the covariance, centred before multiplying; the projections.  A task adds
up its own vectors batch by batch and passes on one row per dimension.  The driver
only holds the covariance, whose size is fixed by the dimension and not by the rows.

The eigenvectors come from contour integrals (FEAST):

1. Householder reflections bring the covariance to tridiagonal form; the inertia of a
   shifted tridiagonal matrix (signs of its LDL' pivots) counts the eigenvalues above
   any shift.  Bisection on these counts places intervals that hold the wanted
   eigenvalues, with borders in gaps of the spectrum.
2. For each interval, Gauss-Legendre nodes on a circle through its ends give complex
   shifted systems ``(zI - V) X = Y``; their weighted sum projects a block of vectors
   onto the interval's eigenvectors.  Rayleigh-Ritz extracts pairs, which start the
   next pass, until the residuals are at rounding level.
3. The number of pairs found in an interval must equal its inertia count; otherwise the
   block is doubled.  Nothing is returned unverified.

Defined results.  A vector that is null, or holds a null or a non-finite entry, is
dropped.  So is one whose length is not the table's most frequent length (ties: the
longer).  ``floor(1024 * c)`` beyond +-2^62 is held there.  Repeated rows and ids each
count and each return rows; a null id stays null.  Components whose eigenvalue is zero
within rounding have no direction and no rows (all rows equal, a single row, constant
dimensions).  ``deviation`` is exact, and null where it is no 64-bit number (possible
only beyond some million rows).  Very long vectors need two matrices of dimension
squared on the driver.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_package
from tidemark.session import materialise

#: Entries become ``floor(SCALE * c) + OFFSET`` (fixed values).
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Nodes of the quadrature on the half circle, and passes over one interval.
NODES, PASSES = 8, 30
#: Eigenvalues that one interval holds, if a gap allows.
PER_INTERVAL = 4
SEED = 11


# ------------------------------------------------------------- on the driver
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of a matrix similar to the symmetric ``v``."""
    a = np.array(v, dtype=float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        # both sides of the reflection, on the trailing block at once
        p = a[k + 1 :, k + 1 :] @ x
        q = 2 * (p - (x @ p) * x)
        a[k + 1 :, k + 1 :] -= np.outer(x, q) + np.outer(q, x)
        column = a[k + 1 :, k]
        a[k + 1 :, k] = column - 2 * x * (x @ column)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Inertia: the number of eigenvalues above each shift, by the signs of the
    LDL' pivots of the shifted matrix."""
    diagonal, below = tri
    tiny = np.finfo(float).tiny * 1e8
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[i] - shifts - below[i - 1] ** 2 / pivot
        above += pivot > 0
    return above


def _borders(tri, wanted: int, low: float, high: float) -> list[tuple[float, float, int]]:
    """Intervals (a, b, count) from the top down that hold at least the ``wanted``
    largest eigenvalues; borders stand in gaps as far as there are any."""
    d = len(tri[0])
    least, most = np.full(d, low), np.full(d, high)  # the k-th largest lies between
    ranks = np.arange(1, d + 1)
    for _ in range(60):
        middle = (least + most) / 2
        higher = count_above(tri, middle) >= ranks
        least, most = np.where(higher, middle, least), np.where(higher, most, middle)
    values = (least + most) / 2
    floor = low - (high - low) * 0.05
    gaps = np.append(values[:-1] - values[1:], values[-1] - floor)  # below the k-th
    apart = 1e-9 * (high - low)
    out, top, done = [], high, 0
    while done < wanted:
        # the widest gap among the next few ranks; without one, the first gap there is
        span = [k for k in range(done, min(done + PER_INTERVAL, d)) if gaps[k] > apart]
        k = max(span, key=lambda j: gaps[j]) if span else next(j for j in range(done, d) if gaps[j] > apart or j == d - 1)
        border = values[k] - gaps[k] / 2
        out.append((border, top, k + 1 - done))
        top, done = border, k + 1
    return out


def _interval(v: np.ndarray, a: float, b: float, count: int, size: int, rng) -> tuple[np.ndarray, np.ndarray] | None:
    """Eigenpairs of ``v`` in (a, b) by contour integrals with a block of ``size``
    vectors; None if they do not settle at ``count`` pairs."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (a + b) / 2, (b - a) / 2
    angles = np.pi / 2 * (1 - nodes)
    shifts = centre + radius * np.exp(1j * angles)
    block, before = rng.standard_normal((d, size)), np.inf
    for _ in range(PASSES):
        projected = np.zeros((d, size))
        for z, w, angle in zip(shifts, weights, angles):
            solved = np.linalg.solve(z * np.eye(d) - v, block.astype(complex))
            projected += w / 2 * np.real(radius * np.exp(1j * angle) * solved)
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        vectors = basis @ turned
        inside = (values > a) & (values < b)
        found, pairs = values[inside], vectors[:, inside]
        if len(found) == count:
            residual = np.abs(v @ pairs - pairs * found).max()
            # at rounding level, or no longer falling near it
            if residual <= 4e-16 * d or (residual <= 1e-12 and residual >= before / 2):
                return found, pairs
            before = residual
        block = vectors
    return None


def leading_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding level of the symmetric
    non-negative ``v``, falling, and their unit eigenvectors as columns."""
    d = len(v)
    size = np.abs(v).sum(axis=1).max() if d else 0.0  # no eigenvalue is larger
    if not size > 0:
        return np.zeros(0), np.zeros((d, 0))
    unit, rng = v / size, np.random.default_rng(SEED)
    tri = tridiagonal(unit)
    rounding = 8 * d * np.finfo(float).eps
    real = int(count_above(tri, np.array([rounding]))[0])
    wanted = min(wanted, real)
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    columns = []
    for a, b, count in _borders(tri, wanted, -rounding, 1.0 + 1e-3):
        got, block = None, min(d, count + max(4, count // 2))
        while got is None:
            got = _interval(unit, a, b, count, block, rng)
            if got is None and block == d:
                raise ArithmeticError(f"{count} eigenvalues are counted between {a * size} and {b * size}, but not found")
            block = min(d, 2 * block)
        columns.append(got[1])
    # one Rayleigh-Ritz step over all intervals makes their vectors orthogonal
    basis, _ = np.linalg.qr(np.concatenate(columns, axis=1))
    values, turned = np.linalg.eigh(basis.T @ unit @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * size, (basis @ turned)[:, order]


# ------------------------------------------------------------------ on Spark
def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """x of a batch of equally long arrays."""
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
    return np.clip(np.floor(entries * SCALE), -(2.0**62), 2.0**62).astype(np.int64) + OFFSET


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column("dims").to_numpy()
    for dims in np.unique(lengths):
        yield int(dims), batch.filter(pa.array(lengths == dims))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, e, dims) of the vectors whose entries are all finite."""
    e = F.col(vector_col).cast("array<double>")
    bad = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), e.alias("e"))
        .filter(F.col("e").isNotNull() & ~bad)
        .withColumn("dims", F.size("e"))
    )


def _sums(rows: DataFrame) -> DataFrame:
    """(dims, i, n, s, least, most): per vector length and dimension, the number of
    vectors, the exact sum of x and its extremes; i is -1 for the length itself."""

    def partial(batches):
        from decimal import Decimal

        sums: dict[int, list] = {}
        for batch in batches:
            for dims, part in _by_length(batch):
                n, s, low, high = sums.get(dims, (0, [0] * dims, 0, 0))
                x = _matrix(part.column("e"), dims)
                wide = x.size and max(-int(x.min()), int(x.max())) * len(x) >= 2**62
                added = (x.astype(object) if wide else x).sum(axis=0)
                low, high = (min(low, int(x.min())), max(high, int(x.max()))) if x.size else (low, high)
                sums[dims] = (n + part.num_rows, [a + int(b) for a, b in zip(s, added)], low, high)
        for dims, (n, s, low, high) in sums.items():
            index = list(range(-1, dims))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dims] * len(index), pa.int32()), pa.array(index, pa.int32()),
                    pa.array([n] * len(index), pa.int64()),
                    pa.array([Decimal(v) for v in [0, *s]], pa.decimal128(38, 0)),
                    pa.array([low] * len(index), pa.int64()), pa.array([high] * len(index), pa.int64()),
                ],
                names=["dims", "i", "n", "s", "least", "most"],
            )

    schema = "dims int, i int, n long, s decimal(38,0), least long, most long"
    return rows.mapInArrow(partial, schema).groupBy("dims", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )


class Centring:
    """Exact n * x - S of batches: 64-bit where that holds every value."""

    def __init__(self, n: int, sums: list[int], least: int, most: int):
        self.n, self.dims = n, len(sums)
        self.wide = 2 * n * max(abs(least), abs(most), 1) >= 2**62
        self.sums = np.array(sums, dtype=object if self.wide else np.int64)

    def exact(self, column: pa.Array) -> np.ndarray:
        x = _matrix(column, self.dims)
        return (x.astype(object) if self.wide else x) * self.n - self.sums

    def deviations(self, y: np.ndarray) -> list[int | None]:
        about = (y.astype(float) ** 2).sum(axis=1)
        if self.wide:
            exact = (y * y).sum(axis=1)
            return [int(v) if v < 2**63 else None for v in exact]
        with np.errstate(over="ignore"):  # right modulo 2^64, so right wherever it fits
            exact = (y * y).sum(axis=1)
        return [int(v) if a < 9.2e18 else None for v, a in zip(exact, about)]


def covariance(rows: DataFrame, centring: Centring) -> np.ndarray:
    """V of x over ``rows``: vectors are centred, then multiplied, then added up."""
    dims, n = centring.dims, centring.n

    def partial(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            c = centring.exact(batch.column("e")).astype(float) / n
            total += c.T @ c
        if total.any():
            entries = pa.ListArray.from_arrays(pa.array(np.arange(dims + 1) * dims, pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), entries], names=["i", "entries"])

    parts = rows.select("e").mapInArrow(partial, "i int, entries array<double>")
    found = parts.select("i", F.posexplode("entries").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dims, dims))
    for r in found.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row")).toLocalIterator():
        out[r["i"]] = [cell["v"] for cell in r["row"]]
    return (out + out.T) / (2 * n)


def _empty(spark) -> DataFrame:
    return spark.createDataFrame([], RESULT)


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, eigenvalue double"
)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1, by falling
    eigenvalue), n, deviation, whitened, explained, identity_error, eigenvalue."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_col, vector_col)
    stats = materialise(_sums(rows), "whitening-sums")  # a row per length and dimension
    length = stats.filter("i = -1").orderBy(F.desc("n"), F.desc("dims")).limit(1).head()
    if length is None or length["dims"] == 0:
        return _empty(spark)
    dims, n = length["dims"], length["n"]
    rows = rows.filter(F.col("dims") == dims)
    sums = {r["i"]: int(r["s"]) for r in stats.filter((F.col("dims") == dims) & (F.col("i") >= 0)).collect()}
    centring = Centring(n, [sums[i] for i in range(dims)], length["least"], length["most"])
    v = covariance(rows, centring)
    values, directions = leading_components(v, components)
    if not len(values):
        return _empty(spark)
    onto, trace = directions / np.sqrt(values), float(np.trace(v))
    k = len(values)

    def project(batches):
        for batch in batches:
            y = centring.exact(batch.column("e"))
            w = (y.astype(float) / n) @ onto
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * k, pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(centring.deviations(y), pa.int64()), lists],
                names=["vec_id", "deviation", "w"],
            )

    schema = "vec_id long, deviation long, w array<double>"
    projected = materialise(rows.select("vec_id", "e").mapInArrow(project, schema), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = projected.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).head()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))
    shares = F.array(*[F.lit(float(e) / trace) for e in values])
    eigenvalues = F.array(*[F.lit(float(e)) for e in values])
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
        F.get(eigenvalues, F.col("at")).alias("eigenvalue"),
    )
