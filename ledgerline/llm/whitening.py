"""Whitening of embeddings: blockwise QR, then a bidiagonal qd solver.

Vectors are put on an integer grid, so that counts, sums and deviations are
exact and centring loses nothing.  The statistics are those of the distinct
vectors.  Their centred rows are never multiplied with one another: every
task reduces its rows to a triangle by QR, block after block, and triangles
meet in a tree of a fixed fan-in until one is left.  That one is as large as
the vectors are long, whatever the number of rows.  It is brought to
bidiagonal form by Householder reflections; differential quotient-difference
sweeps with shifts (dqds) give the squared singular values to high relative
accuracy; a twisted factorisation at each gives its vector (Fernando and
Parlett, "Accurate singular values and differential qd algorithms", 1994;
Dhillon and Parlett, "Multiple representations to compute orthogonal
eigenvectors of symmetric tridiagonal matrices", 2004).

Defined cases: rows whose vector is null, empty, or holds a null, a
non-finite entry or one of 2^56 or more are dropped, as are those of another
length than the commonest among the distinct vectors (of equally common ones
the longest).  Rows with a null id are whitened as others; repeated rows are
returned each and fitted once.  Directions without variance cannot be scaled
to one and are left out, so fewer than the asked components are returned for
flat data, and none where all vectors are equal or the table is empty.  Equal
eigenvalues get an arbitrary orthogonal basis.  Other columns are not read.
Very long vectors: a triangle is the square of the length, eight bytes an
entry, and :data:`FAN_IN` of them meet in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 56)   # entries from here on do not fit the grid
FAN_IN = 8
EPS = float(np.finfo(float).eps)

SUMS = "n long, low decimal(38,0), high decimal(38,0), sums array<decimal(38,0)>"
WHITENED = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
            "explained double, identity_error double")


# --- the grid and exact centring -------------------------------------------------


def on_grid(vector: str, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Entries as integers; null where the vector is not usable."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c.cast("double")) < LARGEST))
    grid = F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + shift)
    return F.when((F.size(vector) > 0) & usable, grid)


@dataclass
class Centre:
    """Exact sums of the fitted vectors: n, S by dimension, the range of entries."""

    n: int
    sums: list[int]
    low: int
    high: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: 64-bit integers where they fit, Python's otherwise."""
        base = [s // self.n for s in self.sums]
        rest = [s - b * self.n for s, b in zip(self.sums, base, strict=True)]
        if self.n * (self.high - self.low + 1) < 1 << 62:
            return ((x - np.array(base, np.int64)) * np.int64(self.n)
                    - np.array(rest, np.int64))
        return (x.astype(object) - np.array(base, object)) * self.n - np.array(rest, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles, rounded once."""
        return (self.deviations(x) / self.n).astype(float)


def squared_lengths(d: np.ndarray) -> pa.Array:
    """Sum of squares by row, exact."""
    kind = pa.decimal128(38, 0)
    largest = int(np.abs(d).max(initial=0))
    if d.dtype != object and largest * largest * max(d.shape[1], 1) < 1 << 63:
        return pa.array((d * d).sum(axis=1)).cast(kind)
    exact = d.astype(object)
    return pa.array([int(v) for v in (exact * exact).sum(axis=1)], kind)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sum_up(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, [0] * width, None, None
        for batch in batches:
            x = _matrix(batch.column(0), width)
            if not len(x):
                continue
            lo, hi = int(x.min()), int(x.max())
            exact = x if max(-lo, hi) * len(x) < 1 << 62 else x.astype(object)
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, exact.sum(axis=0), strict=True)]
            low = lo if low is None else min(lo, low)
            high = hi if high is None else max(hi, high)
        if n:
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([low], kind), pa.array([high], kind),
                 pa.array([sums], pa.list_(kind))], names=["n", "low", "high", "sums"])
    return run


def centre_of(fit: DataFrame, width: int) -> Centre:
    """Sums of the one column of ``fit``; one row a dimension reaches the driver."""
    parts = cut(fit.mapInArrow(_sum_up(width), SUMS), "centre")
    n, low, high = parts.agg(F.sum("n"), F.min("low"), F.max("high")).first()
    sums = parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
    by_dimension = {r["pos"]: int(r["s"]) for r in sums.collect()}
    return Centre(int(n), [by_dimension[i] for i in range(width)], int(low), int(high))


# --- blockwise QR ------------------------------------------------------------------


def _triangle(blocks: Iterator[np.ndarray], width: int) -> np.ndarray | None:
    """R of all rows of ``blocks``, a few rows more than ``width`` at a time."""
    r, held, rows = None, [], 0
    for block in blocks:
        for at in range(0, len(block), 4 * width):
            held.append(block[at:at + 4 * width])
            rows += len(held[-1])
            if rows >= 4 * width:
                r = np.linalg.qr(np.vstack(held if r is None else [r, *held]), mode="r")
                held, rows = [], 0
    if rows:
        r = np.linalg.qr(np.vstack(held if r is None else [r, *held]), mode="r")
    return r


def _reduce_rows(centre: Centre):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(centre.sums)
        r = _triangle((centre.rows(_matrix(b.column(0), width)) for b in batches if b.num_rows),
                      width)
        if r is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([r.tobytes()], pa.binary())], names=["at", "r"])
    return run


def _meet(width: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = table.sort_by("at").column("r")
        r = _triangle((np.frombuffer(b.as_py()).reshape(-1, width) for b in found), width)
        return pa.table({"at": pa.array([key[0].as_py()], pa.int64()),
                         "r": pa.array([r.tobytes()], pa.binary())})
    return run


def triangle_of(fit: DataFrame, centre: Centre) -> np.ndarray:
    """R, square, of the centred rows of ``fit``: a tree of QR reductions."""
    width = len(centre.sums)
    parts = cut(fit.mapInArrow(_reduce_rows(centre), "at long, r binary"), "triangles")
    left = int(parts.agg(F.max("at")).first()[0]) + 1
    while left > 1:
        parts = parts.groupBy(F.expr(f"at div {FAN_IN}").alias("g")).applyInArrow(
            _meet(width), "at long, r binary")
        left = -(-left // FAN_IN)
    r = np.frombuffer(parts.first()["r"]).reshape(-1, width)
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


# --- the bidiagonal solver: bounded by the length of a vector ------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(diagonal, superdiagonal, right reflections) of a square matrix."""
    a, n, right = r.astype(float), len(r), []

    def reflection(v: np.ndarray) -> tuple[np.ndarray, float]:
        """Unit w and the value that I - 2ww' leaves in front of ``v``."""
        size = float(np.linalg.norm(v))
        if size == 0:
            return np.zeros_like(v), 0.0
        w = v / size
        front = -1.0 if w[0] >= 0 else 1.0
        w[0] -= front
        return w / np.linalg.norm(w), front * size

    diagonal, above = np.zeros(n), np.zeros(max(n - 1, 0))
    for k in range(n):
        w, diagonal[k] = reflection(a[k:, k])
        a[k:, k + 1:] -= 2 * np.outer(w, w @ a[k:, k + 1:])
        if k + 1 < n:
            w, above[k] = reflection(a[k, k + 1:])
            a[k + 1:, k + 1:] -= 2 * np.outer(a[k + 1:, k + 1:] @ w, w)
            right.append(w)
    return diagonal, above, right


def sweep(q: list[float], e: list[float], shift: float):
    """One dqds transform: (q, e, smallest d, sum of 1/d), or None where the
    shift was too large."""
    n, d = len(q), q[0] - shift
    if d < 0:
        return None
    new_q, new_e, smallest = [0.0] * n, [0.0] * (n - 1), d
    inverse = 1 / d if d > 0 else math.inf
    for k in range(n - 1):
        new_q[k] = d + e[k]
        if new_q[k] <= 0:
            return None
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
        if d < 0:
            return None
        smallest = min(smallest, d)
        inverse += 1 / d if d > 0 else math.inf
    new_q[n - 1] = d
    return new_q, new_e, smallest, inverse


def singular_squares(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by dqds.

    The shift comes from the last sweep: close to its smallest d at first, and
    where that fails the bound 1 / sum(1/d) (in exact arithmetic never above
    the smallest value, since the 1/d of a sweep without shift are the diagonal
    of the inverse), then none.  Negligible e split the matrix.
    """
    negligible = (10 * EPS) ** 2
    found: list[float] = []
    stack = [((diagonal * diagonal).tolist(), (above * above).tolist(), 0.0)]
    while stack:
        q, e, moved = stack.pop()
        fresh = True
        for _ in range(100 * len(q) + 100):
            while len(q) > 1 and e[-1] <= negligible * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(moved + q[0])
                q = []
                break
            gaps = [k for k in range(len(e)) if e[k] <= negligible * (moved + q[k])]
            if gaps:
                k = gaps[-1]
                stack.append((q[:k + 1], e[:k], moved))
                q, e, fresh = q[k + 1:], e[k + 1:], True
                continue
            if fresh and 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            if fresh or not smallest:
                q, e, smallest, inverse = sweep(q, e, 0.0)
                plain, fresh = True, False
                continue
            # After a sweep without shift the bound is safe; after one with a
            # shift its d are only estimates, and a failed try costs one sweep.
            bound = 1 / inverse if plain and math.isfinite(inverse) else smallest / len(q)
            for shift in (smallest * (1 - 1e-3) if not plain else bound, 0.5 * bound, 0.0):
                step = sweep(q, e, shift)
                if step:
                    break
            q, e, smallest, inverse = step
            plain = shift == 0.0
            moved += shift
        if q:
            raise ArithmeticError("the qd sweeps do not converge")
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, square: float) -> tuple[np.ndarray, float]:
    """(unit vector, residual) of B'B at the eigenvalue ``square``.

    The stationary transform runs down, the progressive one up; they meet
    where the remainder is smallest, and the vector follows from there by
    multiplications alone.
    """
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0)), 1e-300)
    tiny = EPS * size
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    d, low = (a * a).tolist(), (above / a[:-1]).tolist()
    floor = EPS * EPS * size * size

    def safe(v: float) -> float:
        return v if abs(v) > floor else math.copysign(floor, v)

    down, s = [0.0] * n, [0.0] * n
    s[0] = -square
    for i in range(n - 1):
        down[i] = d[i] * low[i] / safe(s[i] + d[i])
        s[i + 1] = down[i] * low[i] * s[i] - square
    up, p = [0.0] * n, [0.0] * n
    p[n - 1] = d[n - 1] - square
    for i in range(n - 2, -1, -1):
        ratio = d[i] / safe(d[i] * low[i] * low[i] + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - square
    gamma = [abs(s[i] + p[i] + square) for i in range(n)]
    k = min(range(n), key=gamma.__getitem__)
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    length = float(np.linalg.norm(z))
    return z / length, gamma[k] / length


def vectors(diagonal: np.ndarray, above: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B, a column for each of ``squares`` (falling).

    Where values lie so close that their twisted vectors are not orthogonal,
    the vector is found by inverse iteration against those before it.
    """
    n = len(diagonal)
    out = np.zeros((n, len(squares)))
    dense = None
    rng = np.random.default_rng(7)
    for j, square in enumerate(squares.tolist()):
        z, _ = twisted(diagonal, above, square)
        before = out[:, :j]
        if j and np.abs(before.T @ z).max() > 1e-9:
            if dense is None:
                b = np.diag(diagonal) + np.diag(above, 1)
                dense = b.T @ b
            near = before[:, np.abs(squares[:j] - square) <= 1e-3 * square]
            shifted = dense - square * (1 + 4 * EPS) * np.eye(n)
            shifted[np.diag_indices(n)] += EPS * squares[0]
            z = rng.standard_normal(n)
            for _ in range(4):
                z -= near @ (near.T @ z)
                z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        for _ in range(2):
            z = z - before @ (before.T @ z)
            z /= np.linalg.norm(z)
        out[:, j] = z
    return out


@dataclass
class Whitening:
    """What the rows need: the centre, the scaled directions, the eigenvalues' shares."""

    centre: Centre
    directions: np.ndarray    # a column for each component, over its deviation
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def solve(r: np.ndarray, centre: Centre, components: int = COMPONENTS) -> Whitening:
    """Directions and eigenvalues of the covariance R'R / n."""
    diagonal, above, right = bidiagonalise(r)
    squares = singular_squares(diagonal, above)
    total = float(squares.sum())
    kept = squares[:components]
    # Below this a direction is rounding of the others.
    kept = kept[kept > len(r) * (EPS * 8) ** 2 * squares[0]] if total > 0 else kept[:0]
    z = vectors(diagonal, above, kept)
    for k in range(len(right) - 1, -1, -1):     # back through the reflections
        w = right[k]
        z[k + 1:] -= 2 * np.outer(w, w @ z[k + 1:])
    values = kept / centre.n
    return Whitening(centre, z / np.sqrt(values), values, kept / total if total else kept)


# --- fit and apply ---------------------------------------------------------------------


def _squares_of(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, k = model.directions.shape
        total = np.zeros((k, k))
        for batch in batches:
            w = model.centre.rows(_matrix(batch.column(0), width)) @ model.directions
            total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k * k), pa.int32()), pa.array(total.reshape(-1))],
            names=["cell", "s"])
    return run


def fit_whitening(grid: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``grid`` (column ``x``); None without any.

    The distinct vectors are written once: three passes read them.
    """
    fit = cut(grid.filter("x is not null").select("x").distinct(), "distinct")
    widths = fit.groupBy(F.size("x").alias("width")).count()
    commonest = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if commonest is None:
        return None
    width = commonest["width"]
    fit = fit.filter(F.size("x") == width)
    centre = centre_of(fit, width)
    model = solve(triangle_of(fit, centre), centre, components)
    k = len(model.values)
    if k:
        sums = fit.mapInArrow(_squares_of(model), "cell int, s double").groupBy("cell").agg(
            F.sum("s").alias("s")).collect()     # as many rows as components squared
        covariance = np.zeros(k * k)
        for row in sums:
            covariance[row["cell"]] = row["s"] / centre.n
        model.identity_error = float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())
    return model


def _whiten(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, k = model.directions.shape
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                d = model.centre.deviations(_matrix(part.column(1), width))
                w = (d / model.centre.n).astype(float) @ model.directions
                rows = np.repeat(np.arange(len(d)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(d))),
                     pa.array(np.full(len(rows), model.centre.n, np.int64)),
                     squared_lengths(d).take(pa.array(rows)), pa.array(w.reshape(-1)),
                     pa.array(np.tile(model.explained, len(d))),
                     pa.array(np.full(len(rows), model.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])
    return run


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Every usable row's whitened components, one row for each."""
    grid = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"),
                             on_grid(vector).alias("x"))
    model = fit_whitening(grid, components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    usable = grid.filter(F.size("x") == len(model.centre.sums))
    return usable.mapInArrow(_whiten(model), WHITENED)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened to 16 components."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
