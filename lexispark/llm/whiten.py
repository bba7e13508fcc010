"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, x = floor(64 c) + 1000000, so counts and sums
are exact. The fit list is each distinct x vector once (copies would weigh a
passage by how often it was crawled): n vectors with per-dimension sums S.
With X the centred list, (n x - S) / n -- the numerator exact, so centring
costs no digits -- the process alternates two distributed products:

    p = X v_j,    made orthogonal to u_1 .. u_(j-1)  ->  alpha_j, u_j
    r = X' u_j,   made orthogonal to v_1 .. v_j      ->  beta_j, v_(j+1)

Left vectors are as long as the list, so none is kept: as u_j is a fixed
combination of X v_1 .. X v_j, U R = X V with R triangular, each task makes
the columns for its own rows by one product and one triangular solve. The
products and the coefficients U'p come back as sums of d + j numbers for each
partition. Both sides are fully reorthogonalised, the left one in two rounds
(the sums of the first go out with the second product). The driver holds V,
R and the bidiagonal matrix, at most d x d numbers. Its small SVD gives the
components, X'X / n = W diag(e) W', and deviations sqrt(e). Steps go on until
the residuals of the wanted components are at rounding level, or the space
is used up; where beta vanishes earlier (eigenvalues that occur more than
once, or rank below d), the process goes on with a new direction orthogonal to all before.

Rows whose vector is null or holds null or non-finite entries go, and vectors
of another length than the most frequent one (ties: the longer); a null id
stays. Repeated rows keep their rows and count once in the fit. Components
whose eigenvalue is rounding error (below 1e-12 of the largest) are not
returned; a list of equal vectors, or of one, has none, so no rows, as an
empty table has none. Where eigenvalues tie, any basis of their space may
come. Sums that leave 64 bits raise. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
#: eigenvalues below this share of the largest are rounding error
RANK = 1e-12
#: lengths below this share of the largest are rounding error
NOTHING = 1e-12


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that remain."""
    entries = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("c")).where(F.col("c").isNotNull())
    given = given.where(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    sizes = given.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    given = given.where(F.size("c") == (sizes[0].d if sizes else 0))
    return given.select("vec_id", F.transform("c", lambda c: F.floor(F.lit(SCALE) * c) + F.lit(SHIFT)).alias("x"))


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n with an exact numerator."""
    return (n * x - sums) / n


class FitList:
    """The stored distinct vectors, their count and exact sums."""

    def __init__(self, vectors: DataFrame, name: str = "fit-list"):
        self.rows = stored(vectors.select("x").distinct(), name, "zstd")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows and len(b.column(0)[0]):
                    x = _rows(b.column(0), len(b.column(0)[0]))
                    if np.abs(x).max() > 1 << 48:
                        raise OverflowError("an entry is too large for sums of 64 bits")
                    yield pa.RecordBatch.from_arrays([pa.array(range(x.shape[1]), pa.int32()), pa.array(x.sum(axis=0)), pa.array([len(x)] * x.shape[1], pa.int64())], names=["i", "s", "n"])

        made = sorted(self.rows.mapInArrow(run, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
        self.sums = np.array([r.s for r in made], np.int64)
        self.n, self.d = (made[0].n if made else 0), len(made)

    def total(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum of ``of(batch of centred rows)``, ``size`` numbers."""
        n, sums, d = self.n, self.sums, self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    held += of(centred(_rows(b.column(0), d), n, sums))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(held)], names=["i", "s"])

        # (i, s) of each task are added up before they come to the driver
        made = self.rows.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
        return np.array([r.s for r in sorted(made)])


def _solve(x_v: np.ndarray, r: np.ndarray) -> np.ndarray:
    """U of U R = X V, column by column."""
    u = np.empty_like(x_v)
    for j in range(r.shape[1]):
        u[:, j] = (x_v[:, j] - u[:, :j] @ r[:j, j]) / r[j, j]
    return u


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(fit: FitList, k: int, seed: int = 11, tolerance: float = 1e-14) -> tuple[np.ndarray, np.ndarray, int]:
    """(components as columns, eigenvalues, steps) of the ``k`` largest."""
    rng = np.random.default_rng(seed)
    d = fit.d
    basis = np.zeros((d, 0))  # v_1, v_2, ...
    led = np.zeros((d, 0))  # those of them that led to a u
    r = np.zeros((0, 0))  # U R = X led
    b = np.zeros((0, 0))  # U' X V, upper bidiagonal
    xt_u = np.zeros((d, 0))  # X' u_1, X' u_2, ...
    v, beta = rng.normal(size=d), 0.0
    v /= np.linalg.norm(v)
    while True:
        j, known, coef = len(r), led, r

        def product(x: np.ndarray) -> np.ndarray:
            return _solve(x @ known, coef).T @ (x @ v)

        first = fit.total(product, j) if j else np.zeros(0)

        def transposed(x: np.ndarray) -> np.ndarray:
            u = _solve(x @ known, coef)
            p = x @ v - u @ first
            return np.concatenate([[p @ p], u.T @ p, x.T @ p])

        back = fit.total(transposed, 1 + j + d)
        again, x_t = back[1 : 1 + j], back[1 + j :]
        alpha = float(np.sqrt(max(back[0] - again @ again, 0.0)))
        scale = max(float(np.abs(b).max(initial=0.0)), alpha)
        if alpha <= NOTHING * scale and not beta:
            break  # X is nothing on what is left
        basis = np.concatenate([basis, v[:, None]], axis=1)
        b = np.pad(b, ((0, 0), (0, 1)))
        if beta:
            b[j - 1, -1] = beta
        rest, beta = np.zeros(d), 0.0
        if alpha > NOTHING * scale:
            led = np.concatenate([led, v[:, None]], axis=1)
            r = np.pad(r, ((0, 1), (0, 1)))
            r[:, j] = [*(first + again), alpha]
            b = np.pad(b, ((0, 1), (0, 0)))
            b[j, -1] = alpha
            u_t = (x_t - xt_u @ again) / alpha
            xt_u = np.concatenate([xt_u, u_t[:, None]], axis=1)
            rest = _orthogonal(u_t, basis)
            beta = float(np.linalg.norm(rest))
        if basis.shape[1] == d:
            break
        left, sigma, _ = np.linalg.svd(b)
        if beta <= NOTHING * sigma[0]:  # an invariant space is complete: go on beside it
            rest, beta = _orthogonal(rng.normal(size=d), basis), 0.0
        elif len(b) >= k and (beta * np.abs(left[-1, :k]) <= tolerance * sigma[0]).all():
            break
        v = _orthogonal(rest / np.linalg.norm(rest), basis)
        v /= np.linalg.norm(v)
    if not len(b):
        return np.zeros((d, 0)), np.zeros(0), 0
    _, sigma, right = np.linalg.svd(b)
    values = sigma**2 / fit.n
    rank = int((values > RANK * values[0]).sum())
    keep = min(k, rank)
    return (basis @ right.T)[:, :keep], values[:keep], basis.shape[1]


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """For each remaining row and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    vectors = whole_vectors(embeddings)
    fit = FitList(vectors)
    spark = embeddings.sparkSession
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not fit.n or not fit.d:
        return spark.createDataFrame([], names)
    w, e, _ = bidiagonalise(fit, components)
    if not len(e):
        return spark.createDataFrame([], names)
    trace = float(fit.total(lambda x: np.array([(x * x).sum()]), 1)[0]) / fit.n
    scaled = w / np.sqrt(e)
    q = len(e)

    def second(x: np.ndarray) -> np.ndarray:
        y = x @ scaled
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    moments = fit.total(second, q + q * q) / fit.n
    mean = moments[:q]
    error = float(np.abs(moments[q:].reshape(q, q) - np.outer(mean, mean) - np.eye(q)).max())
    explained = e / trace
    n, d, sums = fit.n, fit.d, fit.sums

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y = centred(_rows(b.column(2), d), n, sums) @ scaled
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(y.tolist(), pa.list_(pa.float64()))], names=["vec_id", "deviation", "y"])

    apart = F.transform("x", lambda x, i: F.lit(n) * x - F.element_at(F.lit([int(s) for s in fit.sums]), i + 1))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda held, x: held + x * x)
    rows = vectors.select("vec_id", deviation.alias("deviation"), "x").mapInArrow(project, "vec_id long, deviation long, y array<double>")
    spread = rows.select("vec_id", "deviation", F.posexplode("y").alias("i", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit([float(x) for x in explained]), F.col("i") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
