"""Whitening of embeddings with the leading components of their covariance.

Entries become whole numbers, x = floor(64 c) + 1000000. The fit list has each distinct x vector
once; n is its size, S its sums. Components are eigenvectors of its covariance V, found by the
Jacobi-Davidson method without V ever being put together: tasks hold blocks of the fit list,
centre them exactly as (n x - S) / n, and add up X' (X b) for a few vectors b at a time. The
correction equations of all open pairs, projected against the wanted and the locked vectors, run
through the steps of MINRES side by side, so that a step is one pass over the fit list, as is the
extension of the subspace. Rayleigh-Ritz on the subspace gives the next pairs. The leading ones
whose residual has reached double precision are locked, and the run ends when all are.

The driver holds vectors of one entry a dimension, never rows. Vectors that are null, or have null
or non-finite entries, are dropped; so are those whose length is not the commonest (of equally
common ones the longer counts), and empty ones. Entries beyond 2^40 count as 2^40. Repeated
rows come out each, with equal values. Components without variance are left out, so a table
with one distinct vector, and an empty one, give no rows. A deviation that no long can hold is
null. Null ids are kept; other columns are left out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged

COMPONENTS = 16
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**40
#: Bytes of a block of the fit list, and rows written at once.
BLOCK_BYTES, OUT_ROWS = 4 << 20, 4_096

#: Residuals of locked pairs, relative to the largest eigenvalue.
PRECISION = 512 * np.finfo(float).eps
#: Steps of MINRES for a correction, and subspaces as multiples of the wanted number.
INNER, LARGEST_SPACE, KEPT_SPACE = 4, 5, 2
ROUNDS = 500

Product = Callable[[np.ndarray], np.ndarray]


def as_integers(embedding: str) -> Column:
    """The x vector; null where the vector is to be dropped."""
    c = F.col(embedding).cast("array<double>")
    usable = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    bounded = F.transform(c, lambda e: F.floor(SCALE * F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), e))) + SHIFT)
    return F.when(usable & (F.size(c) > 0), bounded)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


@dataclass
class FitList:
    """The distinct vectors in blocks, a binary row each, with their number and sums."""

    blocks: DataFrame
    d: int
    n: int = 0
    sums: np.ndarray | None = None

    def __post_init__(self):
        d = self.d

        def added(batches):
            n, sums = 0, np.zeros(d, np.int64)
            for x in _blocks(batches, d):
                n += len(x)
                sums += x.sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(sums), pa.array(np.full(d, n))], ["j", "s", "n"])

        self.sums = np.zeros(d, np.int64)
        parts = self.blocks.mapInArrow(added, "j long, s long, n long").groupBy("j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for row in parts.collect():  # one row a dimension
            self.sums[row["j"]], self.n = row["s"], row["n"]

    def total(self, part: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum of ``part``, an array of rows by columns, over the centred blocks."""
        d, n, sums = self.d, self.n, self.sums

        def run(batches):
            made = np.zeros((rows, columns))
            for x in _blocks(batches, d):
                made += part((n * x - sums) / n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), *map(pa.array, made.T.copy())], ["j", *names])

        names = [f"v{i}" for i in range(columns)]
        parts = self.blocks.mapInArrow(run, ", ".join(["j long", *[f"{v} double" for v in names]]))
        out = np.zeros((rows, columns))
        for row in parts.groupBy("j").agg(*[F.sum(v).alias(v) for v in names]).collect():  # ``rows`` rows
            out[row["j"]] = row[1:]
        return out

    def covariance_times(self, width: int) -> Product:
        """V b for blocks b of vectors, ``width`` at a time."""

        def product(b: np.ndarray) -> np.ndarray:
            made = []
            for at in range(0, b.shape[1], width):
                some = np.zeros((self.d, width))
                some[:, : b.shape[1] - at] = b[:, at : at + width]
                made.append(self.total(lambda c, some=some: c.T @ (c @ some), self.d, width) / self.n)
            return np.hstack(made)[:, : b.shape[1]]

        return product


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch["block"]:
            yield np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d)


def fit_list(vectors: DataFrame, d: int) -> FitList:
    """From (x); each distinct one counts once."""
    rows = max(1, BLOCK_BYTES // (8 * d))

    def run(batches):
        for batch in batches:
            x = _matrix(batch["x"], d)
            parts = [x[at : at + rows].astype("<i8").tobytes() for at in range(0, len(x), rows)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["block"])

    return FitList(staged(vectors.select("x").distinct().mapInArrow(run, "block binary"), "fit_list"), d)


def minres(times: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """A few steps of MINRES (Paige and Saunders, 1975) for every column of ``rhs`` at once.
    ``times`` applies each column's own symmetric operator to that column."""
    tiny = np.finfo(float).tiny
    norm = np.linalg.norm(rhs, axis=0)
    x = np.zeros_like(rhs)
    basis, before = rhs / np.maximum(norm, tiny), np.zeros_like(rhs)
    beta = np.zeros_like(norm)
    left = norm.copy()  # the residual's part that is still to be turned away
    cosines, sines = [np.ones_like(norm)] * 2, [np.zeros_like(norm)] * 2
    directions = [np.zeros_like(rhs)] * 2
    for _ in range(steps):
        following = times(basis) - beta * before
        alpha = (basis * following).sum(0)
        following -= alpha * basis
        beta_next = np.linalg.norm(following, axis=0)
        # The new column of the tridiagonal matrix, under the two rotations before it.
        far = sines[0] * beta
        near = cosines[0] * beta
        middle = cosines[1] * near + sines[1] * alpha
        corner = cosines[1] * alpha - sines[1] * near
        length = np.maximum(np.hypot(corner, beta_next), tiny)
        cosine, sine = corner / length, beta_next / length
        direction = (basis - far * directions[0] - middle * directions[1]) / length
        x += cosine * left * direction
        left = -sine * left
        cosines, sines, directions = [cosines[1], cosine], [sines[1], sine], [directions[1], direction]
        before, basis, beta = basis, following / np.maximum(beta_next, tiny), beta_next
        basis[:, beta_next <= 1e-14 * np.maximum(np.abs(alpha), tiny)] = 0.0
    return x


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Columns that span what ``new`` adds to ``others``; what adds nothing but rounding goes."""
    fixed = np.hstack(others)
    new = new / np.maximum(np.linalg.norm(new, axis=0), np.finfo(float).tiny)
    kept = np.empty((len(new), 0))
    for column in new.T:
        v = column.copy()
        for _ in range(3):
            v -= fixed @ (fixed.T @ v)
            v -= kept @ (kept.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v /= size
        else:
            kept = np.column_stack([kept, v])
    return kept


def leading_pairs(product: Product, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    locked, locked_times = np.empty((d, 0)), np.empty((d, 0))
    values = np.empty(0)
    space = np.linalg.qr(np.random.default_rng(7).normal(size=(d, wanted)))[0]
    times = product(space)
    largest = 0.0
    for _ in range(ROUNDS):
        theta, turn = np.linalg.eigh((space.T @ times + times.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, times = space @ turn, times @ turn
        largest = max(largest, float(theta[0]), float(values.max(initial=0.0)))
        open_pairs = min(wanted - len(values), len(theta))
        residuals = times[:, :open_pairs] - space[:, :open_pairs] * theta[:open_pairs]
        done = np.linalg.norm(residuals, axis=0) <= PRECISION * largest
        lock = open_pairs if done.all() else int(np.argmin(done))
        if lock:
            locked, locked_times = np.hstack([locked, space[:, :lock]]), np.hstack([locked_times, times[:, :lock]])
            values = np.r_[values, theta[:lock]]
            space, times, theta, residuals = space[:, lock:], times[:, lock:], theta[lock:], residuals[:, lock:]
            open_pairs -= lock
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if space.shape[1] + open_pairs > LARGEST_SPACE * wanted:
            space, times = space[:, : KEPT_SPACE * wanted], times[:, : KEPT_SPACE * wanted]
        away = np.hstack([locked, space[:, :open_pairs]])

        def projected(v: np.ndarray) -> np.ndarray:
            v = v - away @ (away.T @ v)
            made = product(v) - v * theta[:open_pairs]
            return made - away @ (away.T @ made)

        right = -(residuals - away @ (away.T @ residuals))
        new = _orthonormal(minres(projected, right, INNER), locked, space)
        if not new.shape[1]:
            # Nothing to add: the subspace is whole, or its products carry the rounding of many turns.
            space = _orthonormal(np.hstack([space, np.random.default_rng(len(values)).normal(size=(d, wanted))]), locked)
            times = product(space)
        else:
            space, times = np.hstack([space, new]), np.hstack([times, product(new)])
    raise ArithmeticError(f"{len(values)} of {wanted} components reached double precision")


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each vector that is not dropped and each component: vec_id, component, n, deviation,
    whitened, explained, eigenvalue and identity_error."""
    spark = vectors.sparkSession
    usable = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), as_integers(embedding).alias("x")).where("x is not null")
    id_type = usable.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, eigenvalue double, identity_error double"
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if not lengths:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    usable = usable.where(F.size("x") == d)
    fit = fit_list(usable, d)
    n, sums = fit.n, fit.sums
    trace = float(fit.total(lambda c: (c * c).sum(0)[:, None], d, 1).sum()) / n
    if not trace:
        return spark.createDataFrame([], schema)
    wanted = min(components, d)
    values, axes = leading_pairs(fit.covariance_times(wanted), d, wanted)
    some = values > d * np.finfo(float).eps * values[0]
    values, axes = values[some], axes[:, some]
    k = len(values)
    scaled = axes / np.sqrt(values)

    def gram(c: np.ndarray) -> np.ndarray:
        w = c @ scaled
        return np.vstack([w.T @ w, w.sum(0)])

    moments = fit.total(gram, k + 1, k) / n
    covariance = moments[:k] - np.outer(moments[k], moments[k])
    error = float(np.abs(covariance - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), OUT_ROWS):
                ids = batch["vec_id"].slice(at, OUT_ROWS)
                x = _matrix(batch["x"].slice(at, OUT_ROWS), d)
                apart = n * x - sums
                whitened = (apart / n) @ scaled
                rows = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n)),
                        deviations(apart).take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(values / trace, rows)),
                        pa.array(np.tile(values, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "eigenvalue", "identity_error"],
                )

    return usable.mapInArrow(run, schema)


def deviations(apart: np.ndarray) -> pa.Array:
    """Sums of squares of whole numbers, exact; null beyond a long."""
    sums = (apart * apart).sum(1).tolist()
    for row in np.flatnonzero((apart.astype(float) ** 2).sum(1) >= 2.0**62).tolist():
        exact = sum(v * v for v in apart[row].tolist())
        sums[row] = exact if exact < 1 << 63 else None
    return pa.array(sums, pa.int64())
