"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers (``floor(scale * entry)``), so that counts, sums and
deviations from the mean are exact.  The covariance V is never formed: one pass
over the data returns V times a narrow block Q, the sum of ``dev * (dev . Q)`` over
all centred vectors, added up within each task and then in groups of tasks.  The
driver holds blocks of (dimensions x components), whatever the number of vectors.

An iteration filters the block: Chebyshev polynomials of V by their three-term
recurrence, scaled to the unwanted part of the spectrum, keep that part small
and blow up the rest.  Then QR, Rayleigh-Ritz (one more pass), and residuals
``|V q - theta q|``.  Leading pairs whose residual is at rounding level are locked
and projected out, which allows higher degrees for the others.  The degree is
bounded so that the largest open eigenvalue does not drown the smallest wanted
one.  The lower end of the unwanted part is a Lanczos estimate less its residual.
It ends when every wanted pair is certified; a last Rayleigh-Ritz step over the
whole block sets the order and a last pass measures the whitened covariance.

Defined results: a vector that is null, empty, holds a null or non-finite entry,
or an entry of 2**48 and more in size (its whole number has no exact place beside
others) is dropped, and so is one whose length is not the most frequent length (of
equally frequent ones the larger).  No vectors, or only equal ones, give no
components and no rows.  Components whose eigenvalue is rounding error of the
largest (directions without variance) are left out: fewer than ``want``.
``deviation`` is null where it exceeds a long.  A null or repeated id is kept as
it is; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: bytes of one stored block of vectors, at most (or one vector)
BLOCK_BYTES = 1 << 21
#: entries of this size and more are not taken
LARGEST = float(1 << 48)
#: partial sums that go to the driver at once, at most
PARTIALS = 64
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Model:
    """Exact counts and sums of the whole numbers, components (columns of
    ``basis``), their eigenvalues, the trace of V, and the largest entry of the
    whitened covariance less the identity."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector can be taken, of the most frequent length."""
    v = F.col(vector)
    fine = F.coalesce(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False))) & (F.size(v) > 0), F.lit(False))
    rows = df.where(fine)
    length = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size(v) == (length[0].d if length else 0))


def stored(df: DataFrame, vector: str, ident: str, scale: int = 64) -> DataFrame:
    """The usable vectors as written blocks: ``ids``, ``d`` and ``x``, the whole
    numbers as little-endian 64-bit integers, row by row."""
    rows = usable(df, vector).select(F.col(ident).cast("long").alias("id"), F.transform(F.col(vector), lambda c: c.cast("double")).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            d = len(lists.flatten()) // len(lists) if len(lists) else 1
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) * scale).astype("<i8")
            step = max(1, BLOCK_BYTES // (8 * d))
            for i in range(0, len(x), step):
                part = x[i:i + step]
                yield pa.RecordBatch.from_pydict({"ids": pa.array([b.column("id").slice(i, step).to_pylist()], pa.list_(pa.int64())),
                                                  "d": pa.array([d], pa.int32()), "x": pa.array([part.tobytes()], pa.binary())})

    return written(rows.mapInArrow(pack, "ids array<bigint>, d int, x binary"), "vectors", "snappy")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    for b in batches:
        for ids, d, x in zip(b.column("ids"), b.column("d").to_pylist(), b.column("x")):
            yield ids, np.frombuffer(x.as_buffer(), dtype="<i8").reshape(-1, d)


def exact_sums(blocks: DataFrame) -> tuple[int, list[int], list[int]]:
    """Number of vectors, and per dimension sum and sum of squares."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, 0, 0
        for _, x in _arrays(batches):
            wide = x if np.abs(x).max(initial=0) < 1 << 20 else x.astype(object)  # 2**21 bytes of vectors: sums stay exact
            n, s, q = n + len(x), s + wide.sum(axis=0).astype(object), q + (wide * wide).sum(axis=0).astype(object)
        if n:
            d = len(s)
            as_decimal = lambda a: pa.array([str(v) for v in a]).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict({"j": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "s": as_decimal(s), "q": as_decimal(q)})

    rows = (blocks.mapInArrow(part, "j int, n long, s decimal(38,0), q decimal(38,0)")
            .groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("j").collect())
    return (rows[0].n if rows else 0), [int(r.s) for r in rows], [int(r.q) for r in rows]


def _total(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``of(x)`` over all blocks, within tasks, then in ``PARTIALS`` groups."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, x in _arrays(batches):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"k": pa.array([TaskContext.get().partitionId() % PARTIALS], pa.int32()), "s": pa.array([total.tobytes()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s.as_buffer()) for s in t.column("s").combine_chunks()], axis=0)
        return pa.table({"k": t.column("k").slice(0, 1), "s": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(part, "k int, s binary")
    if blocks.rdd.getNumPartitions() > PARTIALS:
        parts = parts.groupBy("k").applyInArrow(add, "k int, s binary")
    rows = sorted((r.k, bytes(r.s)) for r in parts.collect())
    return np.sum([np.frombuffer(s) for _, s in rows], axis=0).reshape(shape) if rows else np.zeros(shape)


class Covariance:
    """V as an operator: a pass over the data for each product."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]):
        self.blocks, self.n, self.passes = blocks, n, 0
        whole = [s // n for s in sums]
        self.shift = np.array(whole, dtype=np.int64)
        self.rest = np.array([(s - n * w) / n for s, w in zip(sums, whole)])

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        shift, rest = self.shift, self.rest
        return lambda x: (x - shift).astype(np.float64) - rest

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q."""
        centred, self.passes = self.centred(), self.passes + 1

        def of(x: np.ndarray) -> np.ndarray:
            dev = centred(x)
            return dev.T @ (dev @ q)

        return _total(self.blocks, of, q.shape) / self.n

    def projected(self, w: np.ndarray) -> np.ndarray:
        """Covariance of the centred vectors' projections on the columns of ``w``."""
        centred, self.passes = self.centred(), self.passes + 1
        c = w.shape[1]

        def of(x: np.ndarray) -> np.ndarray:
            p = centred(x) @ w
            return np.concatenate([p.T @ p, p.sum(axis=0)[None, :]])

        total = _total(self.blocks, of, (c + 1, c)) / self.n
        return total[:c] - np.outer(total[c], total[c])


def _orthonormal(block: np.ndarray, locked: np.ndarray) -> np.ndarray:
    """QR of a block beside locked columns, projected twice."""
    for _ in range(2):
        block = block - locked @ (locked.T @ block)
        block, _ = np.linalg.qr(block)
    return block


def lowest(cov: Covariance, d: int, rng: np.random.Generator, steps: int = 12) -> float:
    """A lower end of the spectrum: the least Ritz value of a short Lanczos run
    less its residual, and not below 0."""
    basis = np.zeros((d, 0))
    v = rng.standard_normal((d, 1))
    alpha, beta = [], []
    for _ in range(min(steps, d)):
        v = v - basis @ (basis.T @ v)
        v = v - basis @ (basis.T @ v)
        size = float(np.linalg.norm(v))
        if basis.shape[1]:
            beta.append(size)
        if size <= EPS * max([1e-300, *map(abs, alpha)]):
            return 0.0 if not alpha else max(0.0, float(np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))[0]))
        v = v / size
        basis = np.concatenate([basis, v], axis=1)
        w = cov.times(v)
        alpha.append(float((v.T @ w).item()))
        v = w
    last = float(np.linalg.norm(v - basis @ (basis.T @ v)))
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta, 1) + np.diag(beta, -1))
    return max(0.0, float(values[0] - last * abs(vectors[-1, 0])))


def _degree(top: float, low: float, most: int = 12, ratio: float = 1e7) -> int:
    """Largest degree whose polynomial at ``top`` is at most ``ratio`` times that at ``low`` (both over 1)."""
    growth = np.arccosh(max(top, 1 + 1e-12)) - np.arccosh(max(low, 1 + 1e-12))
    return max(1, most if growth <= 0 else min(most, int(np.log(ratio) / growth)))


def leading_pairs(cov: Covariance, d: int, want: int, seed: int = 7, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(components, eigenvalues) of the ``want`` largest eigenvalues."""
    rng = np.random.default_rng(seed)
    want = min(want, d)
    size = min(d, want + max(8, want // 2))
    locked = np.zeros((d, 0))
    block = _orthonormal(rng.standard_normal((d, size)), locked)
    floor = lowest(cov, d, rng) if size < d else 0.0
    top, worst = 0.0, np.inf
    for _ in range(rounds):
        image = cov.times(block)
        ritz = block.T @ image
        theta, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        block, image = block @ turn, image @ turn
        top = max(top, float(theta[0]) if len(theta) else 0.0)
        rest = image - block * theta
        rest -= locked @ (locked.T @ rest)
        error = np.linalg.norm(rest, axis=0)
        missing = want - locked.shape[1]
        # certified: at rounding level, or no better than before and near it
        now = float(error[:missing].max())
        limit = 32 * EPS * top if now < worst / 2 or now > 1e-12 * top else now
        worst = now
        done = int(np.argmax(np.append(error[:missing] > limit, True)))
        if done:
            locked = _orthonormal_append(locked, block[:, :done])
            block, theta = block[:, done:], theta[done:]
            worst = np.inf
        if locked.shape[1] >= want or not block.shape[1]:
            break
        low, high = min(floor, float(theta[-1])), float(theta[-1])
        half = max((high - low) / 2, 1e-6 * max(high, EPS * top), 1e-300)
        middle = high - half
        at = lambda value: (value - middle) / half
        degree = _degree(at(theta[0]), at(theta[min(want - locked.shape[1], len(theta)) - 1]))
        block = _filtered(cov, block, locked, degree, middle, half, at(theta[0]))
    else:
        raise ArithmeticError("the subspace iteration was not certified")
    whole = np.concatenate([locked, block], axis=1)
    whole, _ = np.linalg.qr(whole)
    ritz = whole.T @ cov.times(whole)
    theta, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-theta)[:want]
    return whole @ turn[:, order], theta[order]


def _orthonormal_append(locked: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.concatenate([locked, _orthonormal(more, locked)], axis=1)


def _filtered(cov: Covariance, block: np.ndarray, locked: np.ndarray, degree: int, middle: float, half: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the scaled V on a block, divided by its value
    at ``top`` as it goes (no overflow), then made orthonormal."""

    def scaled(q: np.ndarray) -> np.ndarray:
        out = (cov.times(q) - middle * q) / half
        return out - locked @ (locked.T @ out)

    sigma = first = 1 / max(top, 1.0)
    before, now = block, scaled(block) * sigma
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, 2 * after * scaled(now) - sigma * after * before
        sigma = after
    return _orthonormal(now, locked)


def fit(blocks: DataFrame, want: int = 32) -> Model:
    """Mean and leading components of all stored vectors."""
    n, sums, squares = exact_sums(blocks)
    d = len(sums)
    spread = sum(n * q - s * s for s, q in zip(sums, squares))  # n**2 * trace(V), exact
    if not n or not spread:
        return Model(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 0)
    cov = Covariance(blocks, n, sums)
    basis, values = leading_pairs(cov, d, want)
    real = values > 16 * d * EPS * values[0]
    basis, values = basis[:, real], values[real]
    error = np.abs(cov.projected(basis / np.sqrt(values)) - np.eye(len(values))).max()
    return Model(n, sums, basis, values, spread / n / n, float(error), cov.passes)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sum over dimensions of (n * x - sum)**2; null beyond a long."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most * most * len(sums) < 1 << 63:
        t = x * n - np.array(sums, dtype=np.int64)
        return pa.array((t * t).sum(axis=1))
    t = x.astype(object) * n - np.array(sums, dtype=object)
    return pa.array([v if v < 1 << 63 else None for v in (t * t).sum(axis=1).tolist()], pa.int64())


def whitened(blocks: DataFrame, model: Model, ident: str = "vec_id") -> DataFrame:
    """A row for each stored vector and component (from 1): the id, ``component``,
    ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    c = len(model.values)
    weights = model.basis / np.sqrt(model.values) if c else model.basis
    share = model.values / model.trace if c else model.values
    n, sums, error = model.n, model.sums, model.identity_error
    centred = Covariance(blocks, n, sums).centred() if n else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [ident, "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for ids, x in _arrays(batches):
            for i in range(0, len(x) if c else 0, 1024):
                part = x[i:i + 1024]
                m = len(part)
                each = pa.array(np.repeat(np.arange(m), c))
                yield pa.RecordBatch.from_arrays([
                    ids.values.slice(i, m).take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, n, dtype=np.int64)),
                    _deviations(part, n, sums).take(each), pa.array((centred(part) @ weights).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * c, error))], names)

    return blocks.mapInArrow(rows, f"{ident} long, component int, n long, deviation long, whitened double, explained double, identity_error double")
