"""Embedding whitening by block Jacobi-Davidson.

Vectors are whole numbers x, and their covariance V is never built: all that is asked of it are products with a few
columns at a time, each one Spark job over blocks of centred vectors. A search space is projected (Rayleigh-Ritz);
each Ritz vector that has not converged gives a correction equation, orthogonal to what is found, which MINRES
solves roughly, all of a round's equations in step so that they share their products; the corrections enlarge the
space. Ritz pairs are locked in falling order when their residuals reach double precision.

The driver holds matrices with as many rows as a vector has entries, and never a vector of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import shuffle_partitions, stored

#: Fixed values of the contract: x = floor(SCALE * c) + OFFSET, and how many components.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries from here on don't count as finite: x would not fit a long.
LARGEST = float(1 << 50)
#: Entries of a block.
BLOCK = 1 << 18
#: Residuals to reach, as a part of the largest eigenvalue: some units of the last place.
RESIDUAL = 64 * np.finfo(float).eps
#: Eigenvalues of less than this part of the largest, times the dimension, are 0 in double precision.
RANK = 16 * np.finfo(float).eps
#: Steps of MINRES for a correction, and by how much it is to shrink its residual.
INNER_STEPS, INNER_GAIN = 8, 1e-3
MAX_ROUNDS = 200


def usable(table: DataFrame, column: str) -> DataFrame:
    """(vec_id, x): the vectors without null or non-finite entries, as whole numbers.

    Vectors of another length than most have (the longer of equals) are left out too, as are empty ones.
    """
    entries = F.transform(F.col(column), lambda c: c.cast("double"))
    fine = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    x = F.transform("c", lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    rows = (
        table.select("vec_id", entries.alias("c"))
        .where(F.col("c").isNotNull() & (F.size("c") > 0) & F.coalesce(fine, F.lit(False)))
        .select("vec_id", x.alias("x"))
    )
    rows = stored(rows, "vectors")
    # One row for each length.
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows if lengths is None else rows.where(F.size("x") == lengths.length)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A batch of vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


@dataclass(frozen=True)
class Moments:
    """Number of vectors, exact sums of their entries, and a bound of the entries' size."""

    n: int
    sums: tuple[int, ...]
    largest: int

    @classmethod
    def of(cls, rows: DataFrame) -> Moments:
        entry = rows.select(F.posexplode("x").alias("at", "x"))
        summed = entry.groupBy("at").agg(
            F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.max(F.abs("x")).alias("most")
        ).orderBy("at").collect()
        return cls(summed[0].n if summed else 0, tuple(int(r.s) for r in summed), max((r.most for r in summed), default=0))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where they surely fit, else as Python's whole numbers."""
        kind = np.int64 if self.n * self.largest * 2 < 1 << 62 else object
        return x.astype(kind) * self.n - np.asarray(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)

    def squared_length(self, x: np.ndarray) -> pa.Array:
        """Sums of the squared deviations of rows, exact; null if a sum is no long."""
        apart = self.deviations(x)
        most = int(np.abs(apart).max(initial=0))
        if most * most * x.shape[1] < 1 << 63:
            return pa.array((apart.astype(np.int64) ** 2).sum(axis=1))
        sums = (apart.astype(object) ** 2).sum(axis=1)
        return pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())


def _blocks(rows: DataFrame, moments: Moments) -> DataFrame:
    """(z): the centred vectors, many to a row, as the bytes of a matrix."""
    dim = len(moments.sums)
    each = max(1, BLOCK // max(dim, 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = moments.centred(_matrix(batch.column(0), dim))
            parts = [z[at : at + each].tobytes() for at in range(0, len(z), each)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["z"])

    return stored(rows.select("x").mapInArrow(pack, "z binary"), "centred")


class Covariance:
    """V as an operator: what it does to a few columns, and its trace. Every answer is one job over the blocks."""

    def __init__(self, blocks: DataFrame, n: int, dim: int):
        self.blocks, self.n, self.dim = blocks, n, dim
        # Partial sums of tasks are summed by about as many tasks as each of those gets partial sums.
        self.nodes = max(1, round(shuffle_partitions(blocks.sparkSession) ** 0.5))
        self.products = 0

    def _summed(self, of_block, shape: tuple[int, ...]) -> np.ndarray:
        """The sum of a function of the blocks, added up in the same order each time."""
        dim, nodes = self.dim, self.nodes

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total = np.zeros(shape)
            for batch in batches:
                for value in batch.column(0):
                    total += of_block(np.frombuffer(value.as_py()).reshape(-1, dim))
            task = TaskContext.get().partitionId()
            arrays = [pa.array([task % nodes]), pa.array([task]), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "task", "total"])

        def add(table: pa.Table) -> pa.Table:
            table = table.sort_by("task")
            total = sum(np.frombuffer(value.as_py()) for value in table.column("total"))
            return pa.table({"node": table.column("node")[:1], "total": pa.array([total.tobytes()], pa.binary())})

        parts = self.blocks.mapInArrow(partial, "node long, task long, total binary")
        nodes_ = parts.groupBy("node").applyInArrow(add, "node long, total binary").collect()
        return sum(np.frombuffer(bytes(r.total)) for r in sorted(nodes_, key=lambda r: r.node)).reshape(shape)

    def product(self, columns: np.ndarray) -> np.ndarray:
        """V times ``columns``: centred vectors are multiplied, V itself is not formed."""
        self.products += 1
        return self._summed(lambda z: z.T @ (z @ columns), columns.shape) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda z: np.asarray([(z * z).sum()]), (1,))[0]) / self.n

    def whitened_covariance(self, axes: np.ndarray) -> np.ndarray:
        """The covariance of the vectors' products with ``axes``, centred by its own means first."""
        means = self._summed(lambda z: (z @ axes).sum(axis=0), axes.shape[1:]) / self.n

        def of_block(z: np.ndarray) -> np.ndarray:
            w = z @ axes - means
            return w.T @ w

        return self._summed(of_block, (axes.shape[1],) * 2) / self.n


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns that span what ``new`` adds to the orthonormal ``against``; twice, for the last places."""
    kept = against
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(2):
            column = column - kept @ (kept.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:
                break
            column = column / size
        else:
            kept = np.column_stack([kept, column])
    return kept[:, against.shape[1] :]


def corrections(
    product, found: np.ndarray, values: np.ndarray, residuals: np.ndarray, steps: int = INNER_STEPS, gain: float = INNER_GAIN
) -> np.ndarray:
    """Approximate t, orthogonal to ``found``, with P (V - value) P t = -residual for each column; P projects off ``found``.

    MINRES (Lanczos with Givens rotations) for all columns in step: a step is one product for all of them together.
    """
    off = lambda y: y - found @ (found.T @ y)
    b = off(-residuals)
    start = np.linalg.norm(b, axis=0)
    safe = np.where(start > 0, start, 1)
    t, v, v_old = np.zeros_like(b), b / safe, np.zeros_like(b)
    d, d_old = np.zeros_like(b), np.zeros_like(b)
    beta, eta = np.zeros_like(start), start.copy()
    c = c_old = np.ones_like(start)
    s = s_old = np.zeros_like(start)
    active = start > 0
    for _ in range(steps):
        if not active.any():
            break
        w = off(product(v)) - v * values - v_old * beta
        w = off(w)
        alpha = (v * w).sum(axis=0)
        w = w - v * alpha
        beta_new = np.linalg.norm(w, axis=0)
        # The new column of the tridiagonal matrix under the two rotations before, and the one that clears its last entry.
        upper = s_old * beta
        middle = c_old * beta
        over, diagonal = c * middle + s * alpha, c * alpha - s * middle
        r = np.hypot(diagonal, beta_new)
        active &= r > 0
        r = np.where(r > 0, r, 1)
        c_old, s_old, c, s = c, s, diagonal / r, beta_new / r
        d_new = (v - d * over - d_old * upper) / r
        t = np.where(active, t + d_new * (c * eta), t)
        eta = -s * eta
        d, d_old = d_new, d
        active &= np.abs(eta) > gain * start
        lasting = beta_new > 1e-14 * (np.abs(alpha) + beta)
        active &= lasting
        v, v_old, beta = np.where(lasting, w / np.where(lasting, beta_new, 1), 0), v, beta_new
    return off(t)


def jacobi_davidson(
    product, dim: int, wanted: int, seed: int = 42, block: int | None = None, space: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, their unit eigenvectors and residuals.

    ``product`` multiplies the operator with columns. A round works on ``block`` Ritz pairs at once; the search space
    is cut back to its best Ritz vectors beyond ``space`` columns. Raises if residuals don't reach double precision.
    """
    wanted = min(wanted, dim)
    block = min(block or wanted, dim)
    space = min(dim, space or max(3 * wanted, wanted + 2 * block))
    random = np.random.default_rng(seed)
    basis = np.linalg.qr(random.standard_normal((dim, block)))[0]
    image, settled = product(basis), None
    for _ in range(MAX_ROUNDS):
        # Rayleigh-Ritz; locked vectors stay in the basis and are the leading Ritz vectors of it.
        projected = basis.T @ image
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = basis @ turn, image @ turn
        residuals = ritz_image - ritz * values
        sizes = np.linalg.norm(residuals, axis=0)
        enough = RESIDUAL * np.sqrt(dim) * max(abs(values[0]), abs(values[-1]))
        done = sizes <= enough
        locked = int(np.argmin(done)) if not done.all() else len(done)
        if locked >= wanted and len(values) < dim and (settled is None or (values[:wanted] > settled + enough).any()):
            # All found, but an invariant space can lack copies of a repeated eigenvalue: new directions must not add any.
            settled = values[:wanted]
            keep = min(len(values), max(wanted, space - block))
            basis, image = ritz[:, :keep], ritz_image[:, :keep]
            new = _orthonormal(random.standard_normal((dim, min(block, dim - keep))), basis)
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
            continue
        if locked >= wanted:
            found, found_image = ritz[:, :wanted], product(ritz[:, :wanted])
            # The image above is a turned sum of earlier products; what counts is the residual of a fresh one.
            fresh = np.linalg.norm(found_image - found * values[:wanted], axis=0)
            if (fresh <= 4 * RESIDUAL * np.sqrt(dim) * abs(values[0])).all():
                return values[:wanted], found, fresh
            image = product(basis)
            continue
        if len(values) + 1 > space < dim:
            keep = max(locked + block, min(wanted + block, space // 2))
            basis, image = ritz[:, :keep], ritz_image[:, :keep]
        if basis.shape[1] == dim:
            image = product(basis)  # the space is whole: only the products' own rounding is left
            continue
        open_ = [i for i in range(locked, len(values)) if not done[i]][: max(1, min(block, dim - basis.shape[1]))]
        new = basis[:, :0]
        if open_:
            found = ritz[:, : max(open_[-1] + 1, locked)]
            new = _orthonormal(corrections(product, found, values[open_], residuals[:, open_]), basis)
        if not new.shape[1]:
            # The space holds every correction (repeated eigenvalues, or fewer pairs than wanted): new directions go on.
            new = _orthonormal(random.standard_normal((dim, min(block, dim - basis.shape[1]))), basis)
        new = new[:, : max(1, space - basis.shape[1])]
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    raise ArithmeticError(f"Jacobi-Davidson did not reach double precision in {MAX_ROUNDS} rounds")


@dataclass(frozen=True)
class Whitening:
    """Moments of the fit list, and its leading components: eigenvalues, unit eigenvectors, share of the trace."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    @classmethod
    def fit(cls, rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
        """From (x), vectors of one length; None without any."""
        moments = Moments.of(rows)
        if not moments.n:
            return None
        dim = len(moments.sums)
        covariance = Covariance(_blocks(rows, moments), moments.n, dim)
        trace = covariance.trace()
        if not trace:
            return cls(moments, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0)
        values, vectors, _ = jacobi_davidson(covariance.product, dim, components)
        # Directions without variance can't be scaled to 1.
        vary = values > RANK * dim * values[0]
        values, vectors = values[vary], vectors[:, vary]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(values))])
        apart = covariance.whitened_covariance(vectors / np.sqrt(values)) - np.eye(len(values))
        return cls(moments, values, vectors, values / trace, float(np.abs(apart).max()))


_SCHEMA = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])
_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), by usable vector and component.

    A vector is left out if it is null or empty, if an entry is null, not finite or 2**50 or more, or if its length
    is not the most frequent one. Components are numbered from 1 by falling eigenvalue; there are fewer than
    ``components`` where the vectors vary in fewer directions, and so no rows at all where all are equal, or none is
    left. ``deviation`` is null where it is no long. Null ids and repeated rows keep rows of their own and count as
    often in the fit. Other columns are ignored, whatever their names.
    """
    rows = usable(table, column)
    fit = Whitening.fit(rows, components)
    if fit is None or not len(fit.values):
        return table.sparkSession.createDataFrame([], _DDL)
    axes = fit.vectors / np.sqrt(fit.values)
    moments, k, dim = fit.moments, len(fit.values), len(fit.moments.sums)
    explained, error = fit.explained, fit.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # A row becomes k rows.
            for at in range(0, len(whole), 2_000):
                batch = whole.slice(at, 2_000)
                x = _matrix(batch.column(1), dim)
                n = len(x)
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).cast(pa.int64()).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, moments.n)),
                    moments.squared_length(x).take(each),
                    pa.array((moments.centred(x) @ axes).ravel()),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * k, error)),
                ], schema=_SCHEMA)

    return rows.mapInArrow(project, _DDL)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
