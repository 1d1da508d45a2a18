"""Whitening of embeddings with principal components found by a Jacobi-Davidson method.

The covariance matrix is never built: all the driver asks of the vectors is its product with a
block of a few directions, a pass over the list of distinct vectors in which each task centres
its rows, multiplies and sends sums. Around these products the driver keeps a search space.
Rayleigh-Ritz on it gives approximate components; for each one whose residual is not yet down
to double precision a projected correction equation is solved by a few steps of MINRES, all
components in step, so that they share each pass. The corrections widen the space. Components
that have converged are locked, and the search goes on in the space beside them.

The driver holds some hundred directions, whatever the number of vectors. Its small matrices are
worked on with plain element-wise steps: threaded linear algebra beside the JVM was seen to hang.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.session import materialize

# How an entry becomes a whole number.
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 55)  # entries from here on have no such number in a long
MOST_LONG = (1 << 63) - 1

GUARDS = 4  # directions beside the wanted ones
INNER_STEPS = 5
MOST_ROUNDS = 300
CONVERGED = 2.0**-46  # of the largest eigenvalue: a residual of double precision
NOTHING = 2.0**-40  # of the largest eigenvalue: not to be told from zero


# --- vectors as whole numbers ---------------------------------------------------------------


def _is_whole(vector):
    """True for a vector all of whose entries have a whole number."""
    return F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < LARGEST)) & (F.size(vector) > 0)


def _entries(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _integers(dims: int):
    """vec_id and the bytes of the whole numbers of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(SCALE * _entries(batch.column(1), dims)).astype("<i8") + SHIFT
            rows = [row.tobytes() for row in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(rows, pa.binary())], ["vec_id", "x"]
            )

    return run


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def _totals(dims: int):
    """Per dimension, the number and the exact sum of the task's values."""
    bits = 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            upper, lower = (x >> bits).sum(axis=0), (x & ((1 << bits) - 1)).sum(axis=0)
            sums = [s + (u << bits) + v for s, u, v in zip(sums, upper.tolist(), lower.tolist())]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(dims), pa.int32()),
                    pa.array([n] * dims, pa.int64()),
                    pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
                ],
                ["dim", "n", "total"],
            )

    return run


@dataclass(frozen=True)
class Centre:
    """n vectors with sums S: S = n * floor + rest, rest below n, both by dimension."""

    n: int
    floor: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the subtraction of the whole part is exact."""
        return (x - self.floor) - self.rest / self.n


def _sums(size: int, dims: int, centre: Centre, of_rows: Callable[[np.ndarray], np.ndarray]):
    """``size`` numbers summed over the task's centred rows, as (at, value) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of_rows(centre.centred(_matrix(batch.column(0), dims))).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(total)], ["at", "value"]
        )

    return run


class Vectors:
    """The list of distinct vectors, as far as the driver sees it: sums over all of them."""

    def __init__(self, fit: DataFrame, dims: int):
        self.fit, self.dims = fit, dims
        rows = (
            fit.mapInArrow(_totals(dims), "dim int, n long, total decimal(38,0)")
            .groupBy("dim")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            .collect()
        )
        n = rows[0]["n"] if rows else 0
        self.sums = [0] * dims
        for r in rows:
            self.sums[r["dim"]] = int(r["total"])
        parts = [divmod(s, n) for s in self.sums] if n else []
        self.centre = Centre(
            n, np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], float)
        )
        self.passes = 0

    def mean(self, shape: tuple[int, ...], of_rows: Callable[[np.ndarray], np.ndarray]):
        """What ``of_rows`` makes of blocks of centred rows, summed and divided by n."""
        size = int(np.prod(shape))
        run = _sums(size, self.dims, self.centre, of_rows)
        parts = self.fit.mapInArrow(run, "at long, value double")
        total = np.zeros(size)
        for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
            total[r["at"]] = r["value"]
        self.passes += 1
        return (total / self.centre.n).reshape(shape)

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance matrix times a block of directions, centred before multiplying."""
        block = np.ascontiguousarray(block)
        return self.mean(block.shape, lambda rows: rows.T @ (rows @ block))


# --- small dense steps on the driver ----------------------------------------------------------


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a transposed times b."""
    return np.einsum("ij,ik->jk", a, b)


def _apply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,jk->ik", a, b)


def symmetric_eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors by Jacobi rotations of disjoint pairs at a time."""
    a = (matrix + matrix.T) / 2
    m = len(a)
    vectors = np.eye(m)
    seats = list(range(m + m % 2))
    half = len(seats) // 2
    for _ in range(60):
        off = a - np.diag(np.diag(a))
        if np.abs(off).max(initial=0.0) <= 1e-17 * np.abs(a).max(initial=0.0):
            break
        for _ in range(len(seats) - 1):
            # Each meets each once in a sweep; with an odd number one sits out.
            pairs = [sorted(x) for x in zip(seats[:half], seats[: half - 1 : -1])]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = np.array([x for x in pairs if x[1] < m]).T
            apq = a[p, q]
            difference = (a[q, q] - a[p, p]) / 2
            root = np.hypot(difference, apq)
            bottom = difference + np.copysign(root, difference)
            tangent = np.where(apq == 0, 0.0, apq / np.where(bottom == 0, 1.0, bottom))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = tangent * cosine
            rows = a[p], a[q]
            a[p], a[q] = (
                cosine[:, None] * rows[0] - sine[:, None] * rows[1],
                sine[:, None] * rows[0] + cosine[:, None] * rows[1],
            )
            for turned in (a, vectors):
                columns = turned[:, p], turned[:, q]
                turned[:, p], turned[:, q] = (
                    columns[0] * cosine - columns[1] * sine,
                    columns[0] * sine + columns[1] * cosine,
                )
            a[p, q] = a[q, p] = 0.0
    values = np.diag(a)
    by = np.argsort(-values, kind="stable")
    return values[by], vectors[:, by]


def orthonormal(block: np.ndarray, *beside: np.ndarray) -> np.ndarray:
    """Directions that span what the block adds to the orthonormal blocks beside it."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.sqrt((column * column).sum())
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            for other in (*beside, np.array(kept).T if kept else np.empty((len(column), 0))):
                column = column - _apply(other, _dot(other, column[:, None]))[:, 0]
            left = np.sqrt((column * column).sum())
            if left < 1e-8:
                break
            column = column / left
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.empty((len(block), 0))


def minres(
    times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int
) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column, by steps they share."""
    norms = np.sqrt((right * right).sum(axis=0))
    v_old, v = np.zeros_like(right), right / np.where(norms > 0, norms, 1.0)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    solution = np.zeros_like(right)
    eta, beta = norms.copy(), np.zeros(len(norms))
    cos_old, cos = np.ones(len(norms)), np.ones(len(norms))
    sin_old, sin = np.zeros(len(norms)), np.zeros(len(norms))
    for _ in range(steps):
        p = times(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.sqrt((p * p).sum(axis=0))
        delta = cos * alpha - cos_old * sin * beta
        rho1 = np.hypot(delta, beta_new)
        rho2 = sin * alpha + cos_old * cos * beta
        rho3 = sin_old * beta
        going = rho1 > 1e-300
        safe = np.where(going, rho1, 1.0)
        cos_old, cos = cos, np.where(going, delta / safe, 1.0)
        sin_old, sin = sin, np.where(going, beta_new / safe, 0.0)
        w_old, w = w, np.where(going, (v - rho3 * w_old - rho2 * w) / safe, 0.0)
        solution = solution + np.where(going, cos * eta, 0.0) * w
        eta = -sin * eta
        # A column whose Krylov space is used up stays as it is.
        v_old, v = v, p / np.where(beta_new > 1e-300, beta_new, 1.0)
        beta = beta_new
    return solution


def jacobi_davidson(
    times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns."""
    rng = np.random.default_rng(seed)
    block = min(dims, wanted + GUARDS)
    most = max(4 * block, 64)
    locked, values = np.empty((dims, 0)), np.empty(0)
    space = orthonormal(rng.standard_normal((dims, block)))
    image = times(space)
    largest = 0.0
    for _ in range(MOST_ROUNDS):
        ritz, turn = symmetric_eigen(_dot(space, image))
        space, image = _apply(space, turn), _apply(image, turn)
        largest = max(largest, *ritz[:1], *values[:1])
        residuals = image - space * ritz
        sizes = np.sqrt((residuals * residuals).sum(axis=0))
        full = locked.shape[1] + space.shape[1] >= dims
        done = 0
        missing = wanted - locked.shape[1]
        while done < min(missing, len(ritz)) and (full or sizes[done] <= CONVERGED * largest):
            done += 1
        if done:
            locked = np.hstack([locked, space[:, :done]])
            values = np.append(values, ritz[:done])
            space, image, ritz = space[:, done:], image[:, done:], ritz[done:]
            residuals, sizes = residuals[:, done:], sizes[done:]
            missing -= done
        if not missing:
            # A last look: what lies beside must not exceed what is locked.
            if full or not len(ritz) or ritz[0] <= values.min() * (1 + 1e-12):
                break
            values, by = values[:-1], slice(0, locked.shape[1] - 1)
            space = np.hstack([locked[:, -1:], space])
            image = times(space)
            locked = locked[:, by]
            continue
        near = min(len(ritz), missing + GUARDS)
        sought = sizes[:near] > CONVERGED * largest
        beside = np.hstack([locked, space[:, :near]])
        shifts = ritz[:near][sought]

        def project(x: np.ndarray) -> np.ndarray:
            return x - _apply(beside, _dot(beside, x))

        def corrected(x: np.ndarray) -> np.ndarray:
            return project(times(x) - x * shifts)

        right = -project(residuals[:, :near][:, sought])
        added = minres(corrected, right, INNER_STEPS) if sought.any() else right
        if space.shape[1] + added.shape[1] > most:
            space, image = space[:, : 2 * block], image[:, : 2 * block]
        added = orthonormal(added, locked, space)
        if not added.shape[1]:
            added = orthonormal(rng.standard_normal((dims, 1)), locked, space)
        space = np.hstack([space, added])
        image = np.hstack([image, times(added)])
    else:
        raise ArithmeticError(f"residuals of {sizes[:3]} after {MOST_ROUNDS} rounds")
    by = np.argsort(-values, kind="stable")
    return values[by], locked[:, by]


# --- the operator -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Centre and components (as columns, eigenvalues falling) of the distinct vectors."""

    dims: int
    centre: Centre
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float
    passes: int


def fit_whitening(vectors: DataFrame, dims: int, components: int = 16) -> Whitening:
    """The whitening of the distinct ``x`` of a DataFrame of vectors of whole numbers."""
    # A vector in a third of all rows is one row per task before the shuffle.
    fit = materialize(vectors.select("x").distinct(), "distinct_vectors")
    seen = Vectors(fit, dims)
    n = seen.centre.n
    values, directions = np.empty(0), np.empty((dims, 0))
    trace = error = 0.0
    wanted = min(components, dims, n - 1)
    if wanted > 0:
        trace = float(seen.mean((1,), lambda rows: (rows * rows).sum(keepdims=True))[0])
        values, directions = jacobi_davidson(seen.times, dims, wanted)
        there = values > NOTHING * values[0]
        values, directions = values[there], directions[:, there]
        signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
        directions = directions * signs
    if len(values):
        turn = np.ascontiguousarray(directions / np.sqrt(values))
        shape = (len(values), len(values))
        mean = seen.mean(shape[:1], lambda rows: (rows @ turn).sum(axis=0))

        def products(rows: np.ndarray) -> np.ndarray:
            white = rows @ turn - mean
            return white.T @ white

        error = float(np.abs(seen.mean(shape, products) - np.eye(len(values))).max())
    return Whitening(dims, seen.centre, values, directions, trace, error, seen.passes)


def _whitened(model: Whitening):
    n, k, dims = model.centre.n, len(model.values), model.dims
    turn = np.ascontiguousarray(model.directions / np.sqrt(model.values)) if k else None
    rest = model.centre.rest.astype(np.int64)
    squares = sum(int(r) ** 2 for r in rest)
    explained = model.values / model.trace if k else model.values

    def deviations(x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S)**2, by n * x - S = n * y - rest."""
        y = x - model.centre.floor
        most = int(np.abs(y).max(initial=0)) + 1
        if most * max(most, n) * dims > MOST_LONG:
            y, r = y.astype(object), rest.astype(object)
        else:
            r = rest
        exact = [
            n * n * int(q) - 2 * n * int(p) + squares
            for q, p in zip((y * y).sum(axis=1), (y * r).sum(axis=1))
        ]
        return [d if d <= MOST_LONG else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dims)
            ids = np.repeat(np.arange(len(x)), k)
            white = model.centre.centred(x) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(ids), n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(pa.array(ids)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(ids), model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained",
                 "identity_error"],
            )

    return run


def whiten(
    embeddings: DataFrame,
    components: int = 16,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    An entry c becomes the whole number x = floor(64 * c) + 1000000. All statistics are over
    the distinct vectors of whole numbers, n of them with sums S. Components are numbered from
    1 by falling eigenvalue of their covariance matrix (divisor n). ``deviation`` is the exact
    sum over dimensions of (n * x - S)**2, null where a long cannot hold it; ``whitened`` is
    x - S/n along the component over the root of the eigenvalue; ``explained`` is the
    eigenvalue's part of the trace; ``identity_error`` is the largest absolute entry of the
    whitened vectors' covariance minus the identity.

    Left out are rows whose vector is null or empty or holds a null, a NaN, an infinity or an
    entry whose whole number no long holds, and, as a covariance needs one length, vectors of
    another length than the most frequent one (of equals, the greater). There are at most as
    many components as dimensions, and n - 1; those whose eigenvalue cannot be told from zero
    are left out, so equal vectors alone, or an empty table, give an empty result. Repeated rows
    each get their result; a null id stays null. Other columns are not read.
    """
    vectors = embeddings.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).filter(_is_whole(F.col("vector")))
    lengths = vectors.groupBy(F.size("vector").alias("dims")).count()
    length = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    if length is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    dims = length["dims"]
    whole = vectors.filter(F.size("vector") == dims).mapInArrow(
        _integers(dims), "vec_id long, x binary"
    )
    model = fit_whitening(whole, dims, components)
    return whole.mapInArrow(_whitened(model), schema)
