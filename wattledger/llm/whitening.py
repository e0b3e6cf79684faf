"""Whitening of embeddings: principal components by contour integration, rows projected in parallel."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import stored, table

COMPONENTS = 8
STEPS_PER_UNIT, OFFSET = 1024, 100_000
#: Steps beyond this are set to it: a double holds no finer whole numbers.
LARGEST = float(2**52)
#: Points of the quadrature on the upper half of a contour, and how often a subspace is filtered at most.
POINTS, ROUNDS = 16, 24
#: Eigenvalues a larger part of the largest than this count as above zero.
RELATIVE_ZERO = 1e-12


def usable(vector: Column) -> Column:
    """Has entries, none of them null, NaN or infinite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _steps(column: pa.Array, size: int) -> np.ndarray:
    """The rows as whole steps."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    steps = np.clip(np.floor(STEPS_PER_UNIT * flat), -LARGEST, LARGEST).astype(np.int64) + OFFSET
    return steps.reshape(-1, size)


def _column_sums(steps: np.ndarray) -> list[int]:
    exact = len(steps) == 0 or float(np.abs(steps).max()) * len(steps) < 2**62
    return [int(s) for s in (steps if exact else steps.astype(object)).sum(axis=0)]


def _partial_sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, [0] * size
        for batch in batches:
            steps = _steps(batch.column(0), size)
            rows += len(steps)
            sums = [a + b for a, b in zip(sums, _column_sums(steps), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([rows] * size, pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))],
            names=["dim", "n", "total"],
        )

    return run


@dataclass(frozen=True)
class Centre:
    """How many rows there are and their exact sums, as whole steps and what is over."""

    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def over(self) -> np.ndarray:
        """n times the part of a mean beyond its whole steps."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, steps: np.ndarray) -> np.ndarray:
        return (steps - self.whole).astype(np.float64) - self.over / self.n

    def deviations(self, steps: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; None where one does not fit a long."""
        moved = steps - self.whole
        widest = self.n * (float(np.abs(moved).max(initial=0)) + 1)
        if widest**2 * steps.shape[1] >= 2**62:
            moved = moved.astype(object)
        spread = self.n * moved - self.over
        return [int(d) if d < 2**63 else None for d in (spread * spread).sum(axis=1)]


def _partial_products(centre: Centre):
    size = len(centre.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            z = centre.centred(_steps(batch.column(0), size))
            total += z.T @ z
        yield _matrix_rows(total)

    return run


def _matrix_rows(total: np.ndarray) -> pa.RecordBatch:
    rows = pa.array(list(total), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), rows], names=["i", "line"])


def _summed_line(lines: pa.Table) -> pa.Table:
    total = np.sum(np.stack(lines.column("line").to_numpy()), axis=0)
    return pa.table({"i": lines.column("i").slice(0, 1).combine_chunks(), "line": pa.array([total], pa.list_(pa.float64()))})


def _matrix(partials: DataFrame, size: int) -> np.ndarray:
    """The sum of matrices given line by line, summed line by line in parallel; the driver gets one matrix."""
    lines = partials.groupBy("i").applyInArrow(_summed_line, "i int, line array<double>").collect()
    out = np.zeros((size, size))
    for r in lines:
        out[r.i] = r.line
    return out


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and the one beside it of a tridiagonal matrix with the same eigenvalues (reflections)."""
    t = v.copy()
    for k in range(len(t) - 2):
        x = t[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        if (norm := np.linalg.norm(x)) == 0:
            continue
        u = x / norm
        t[k + 1 :, k:] -= 2 * np.outer(u, u @ t[k + 1 :, k:])
        t[:, k + 1 :] -= 2 * np.outer(t[:, k + 1 :] @ u, u)
    return np.diag(t).copy(), np.diag(t, 1).copy()


def inertia_above(diagonal: np.ndarray, beside: np.ndarray, at: float) -> int:
    """How many eigenvalues are above: the positive pivots of the matrix less ``at`` times the identity."""
    tiny = np.finfo(float).tiny
    count, pivot = 0, 1.0
    for a, b in zip(diagonal, np.concatenate([[0.0], beside]), strict=True):
        pivot = a - at - b * b / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def _edges(diagonal: np.ndarray, beside: np.ndarray, top: float, k: int) -> np.ndarray:
    """The k largest eigenvalues, to about ten digits, by counting above ever closer places."""
    out = []
    for j in range(1, k + 1):
        low, high = -top * 1e-9, out[-1] if out else top
        for _ in range(60):
            middle = (low + high) / 2
            if inertia_above(diagonal, beside, middle) >= j:
                low = middle
            else:
                high = middle
        out.append((low + high) / 2)
    return np.array(out)


def _intervals(near: np.ndarray, wanted: int, top: float) -> list[tuple[float, float]]:
    """Intervals that hold the wanted eigenvalues, with their ends amid gaps; wide ranges are several intervals.

    Where the last wanted one has close company, the interval goes on to the widest gap among those known.
    """
    gaps = near[:-1] - near[1:]
    last = wanted - 1 + int(np.argmax(gaps[wanted - 1 :] / near[wanted - 1 : -1].clip(min=top * 1e-15))) if len(gaps) >= wanted else len(near) - 1
    bounds = [top]
    for j in range(last):
        if near[j] > 2 * near[j + 1]:
            bounds.append((near[j] + near[j + 1]) / 2)
    below = near[last + 1] if last + 1 < len(near) else near[last] - max(near[last] * 0.5, top * 1e-9)
    bounds.append((near[last] + below) / 2)
    return [(low, high) for high, low in zip(bounds, bounds[1:], strict=False)]


def _filtered(v: np.ndarray, low: float, high: float, basis: np.ndarray) -> np.ndarray:
    """The basis projected onto the eigenvectors of an interval: a quadrature of solves along a circle around it."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(basis)
    for x, weight in zip(*np.polynomial.legendre.leggauss(POINTS), strict=True):
        turn = radius * np.exp(-0.5j * np.pi * (x - 1))
        out += weight / 2 * (turn * np.linalg.solve((centre + turn) * np.eye(len(v)) - v, basis.astype(complex))).real
    return out


def _interval_pairs(v: np.ndarray, low: float, high: float, expected: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs of an interval, as many as the inertia says."""
    size = len(v)
    scale = max(abs(low), abs(high))
    columns = min(size, expected + max(4, expected))
    while True:
        basis = np.random.default_rng(seed).standard_normal((size, columns))
        best: tuple[float, np.ndarray, np.ndarray] | None = None
        idle = 0
        for _ in range(ROUNDS):
            u, s, _ = np.linalg.svd(_filtered(v, low, high, basis), full_matrices=False)
            u = u[:, s > s[0] * 1e-13]
            ritz, turned = np.linalg.eigh(u.T @ v @ u)
            basis = u @ turned
            inside = (ritz > low) & (ritz <= high)
            if inside.sum() == expected:
                values, vectors = ritz[inside], basis[:, inside]
                worst = float(np.linalg.norm(v @ vectors - vectors * values, axis=0).max(initial=0))
                better = best is None or worst < best[0]
                idle = 0 if best is None or worst < best[0] / 2 else idle + 1
                best = (worst, values, vectors) if better else best
                if worst <= scale * 1e-15 or idle > 2 and best[0] <= scale * 1e-12:
                    return best[1:]
        if best is not None and (best[0] <= scale * 1e-12 or columns == size):
            return best[1:]
        if columns == size:
            raise ArithmeticError(f"{expected} eigenvalues lie in ({low}, {high}], other numbers were found")
        columns = min(size, 2 * columns)


def leading_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above zero of a covariance, falling, at most ``wanted``, and their unit vectors as columns.

    FEAST: for each interval a random basis is filtered by the contour's projector and turned by Rayleigh and
    Ritz until its pairs no longer improve. Inertia counts place the intervals and say how many pairs each
    must give, so none is missed. A vector's largest entry is positive.
    """
    largest = float(np.abs(v).sum(axis=1).max(initial=0))
    if not largest > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / largest
    diagonal, beside = tridiagonal(unit)
    top = 1 + 1e-9
    positive = inertia_above(diagonal, beside, RELATIVE_ZERO)
    wanted = min(wanted, positive)
    near = _edges(diagonal, beside, top, min(positive, 2 * wanted))
    values, vectors = [], []
    for seed, (low, high) in enumerate(_intervals(near, wanted, top)):
        expected = inertia_above(diagonal, beside, low) - inertia_above(diagonal, beside, high)
        if expected:
            found = _interval_pairs(unit, low, high, expected, seed)
            values.append(found[0])
            vectors.append(found[1])
    basis, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    ritz, turned = np.linalg.eigh(basis.T @ unit @ basis)
    order = np.argsort(-ritz)[:wanted]
    out = basis @ turned[:, order]
    out = out / np.linalg.norm(out, axis=0)
    signs = np.sign(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])])
    return ritz[order] * largest, out * signs


def _projected(centre: Centre, values: np.ndarray, vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = _steps(batch.column(1), len(centre.sums))
            white = centre.centred(steps) @ vectors / np.sqrt(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(centre.deviations(steps), pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                names=["id", "deviation", "white"],
            )

    return run


def _partial_moments(size: int):
    """Products of whitened entries, with a last line and column for the entries' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            white = batch.column(0).flatten().to_numpy().reshape(-1, size)
            with_one = np.concatenate([white, np.ones((len(white), 1))], axis=1)
            total += with_one.T @ with_one
        yield _matrix_rows(total)

    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: ``id_col``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Vectors that are null or empty or hold a null, NaN or infinite entry take no part. Entries become whole
    steps, floor(1024 c) + 100000; those beyond 2^52 steps count as that many. Vectors of another length than
    the most frequent one (of two, the longer) take no part. All others are fitted and returned: repeated
    rows count each, ids may be null or repeat. Components are those with a variance above zero, so equal
    rows, or one row, give none. ``deviation`` is null where it does not fit a long. Columns other than the
    two named ones do not matter.

    The rows are read four times: exact sums, products of centred rows, projections, and the covariance of
    what was projected. Each task sends one matrix of the vector's length, summed line by line in parallel;
    one such matrix reaches the driver, which finds the components. No row is shuffled.
    """
    spark = embeddings.sparkSession
    schema = f"{id_col} {embeddings.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    size = sizes[0]["size"]
    rows = rows.where(F.size("v") == size)
    sums = rows.select("v").mapInArrow(_partial_sums(size), "dim int, n bigint, total decimal(38,0)")
    totals = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    centre = Centre(totals[0]["n"], [int(r["total"]) for r in totals])
    covariance = _matrix(rows.select("v").mapInArrow(_partial_products(centre), "i int, line array<double>"), size) / centre.n
    values, vectors = leading_components((covariance + covariance.T) / 2, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    kind = embeddings.schema[id_col].dataType.simpleString()
    white = stored(rows.mapInArrow(_projected(centre, values, vectors), f"id {kind}, deviation bigint, white array<double>"))
    moments = _matrix(white.select("white").mapInArrow(_partial_moments(k), "i int, line array<double>"), k + 1) / centre.n
    spread = moments[:k, :k] - np.outer(moments[:k, k], moments[:k, k])
    error = float(np.abs(spread - np.eye(k)).max())
    shares = F.array(*[F.lit(float(s)) for s in values / np.trace(covariance)])
    return white.select(F.col("id").alias(id_col), "deviation", F.posexplode("white").alias("at", "whitened")).select(
        id_col,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
