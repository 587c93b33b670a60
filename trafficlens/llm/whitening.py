"""Whitening of embeddings by a distributed Jacobi-Davidson iteration.

An entry c stands for the integer x = floor(1024 c) + 100000. Everything
returned depends on differences of x only, so the vectors are stored and
summed as y = x - 100000: no digits are lost to the offset.

The covariance V is never formed. The iteration needs products V P with a
few columns P; each is one Spark job that adds (y - m)((y - m)' P) over all
vectors, centred before multiplying. The subspace, its small Rayleigh-Ritz
problem and the recurrences of the inner MINRES hold d x columns numbers on
the driver, whatever the number of vectors.

Defined cases: a null vector and one that holds a null, a NaN or an infinity
are dropped; so are vectors whose length is not the most frequent one (the
longer at a tie). Entries beyond 2**45 / 1024 count as that bound. Repeated
rows and ids and null ids stay, each a vector of its own. Directions without
variance have no component, so a table of one vector, or of equal ones,
gives no rows, as does an empty one. ``deviation`` is null where it exceeds
a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import fresh_path

SCALE = 1024
BOUND = float(1 << 45)
BLOCK_BYTES = 4 << 20  # of a staged row
EPS = float(np.finfo(np.float64).eps)
REACHED = 64 * EPS  # residual, relative to the largest eigenvalue
FLOOR = 1e-12  # a residual below it that no longer falls has met rounding


# ---------------------------------------------------------------- staging

def _valid(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of y) by vector length; invalid rows left out."""
    col = col.cast(pa.large_list(pa.float64()))
    sizes = pc.list_value_length(col).fill_null(-1).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        flat = col.take(pa.array(rows)).flatten()
        y = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dim)  # nulls become NaN
        good = np.isfinite(y).all(axis=1)
        if good.any():
            yield rows[good], np.clip(np.floor(y[good] * SCALE), -BOUND, BOUND).astype(np.int64)


def _packed(y: np.ndarray) -> tuple[int, bytes]:
    """Width in bytes and the little-endian integers of a matrix."""
    top = int(np.abs(y).max())
    width = next(w for w in (2, 4, 8) if top < 1 << (8 * w - 1))
    return width, y.astype(f"<i{width}").tobytes()


def _pack(batches):
    for batch in batches:
        for rows, y in _valid(batch.column(1)):
            step = max(1, BLOCK_BYTES // (8 * y.shape[1]))
            ids = batch.column(0).cast(pa.int64()).take(pa.array(rows))
            for lo in range(0, len(rows), step):
                part = y[lo:lo + step]
                width, data = _packed(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.shape[1]], pa.int32()), pa.array([len(part)], pa.int64()),
                     pa.array([width], pa.int32()), pa.array([ids.slice(lo, step).to_pylist()], pa.list_(pa.int64())),
                     pa.array([data], pa.binary())], names=["dim", "n", "width", "ids", "y"])


def stage(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Blocks (dim, n, width, ids, y) of integer vectors, in the shared folder:
    the products read them many times."""
    path = fresh_path(vectors.sparkSession, "whitening")
    blocks = vectors.select(vec_id, embedding).mapInArrow(
        _pack, "dim int, n bigint, width int, ids array<bigint>, y binary")
    blocks.write.parquet(path)
    staged = vectors.sparkSession.read.parquet(path)
    best = staged.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    return staged.filter(F.col("dim") == (best.dim if best else 0))


def _matrices(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        dims, widths, data = (batch.column(batch.schema.get_field_index(c)) for c in ("dim", "width", "y"))
        for dim, width, raw in zip(dims.to_pylist(), widths.to_pylist(), data):
            yield np.frombuffer(raw.as_buffer(), f"<i{width}").reshape(-1, dim).astype(np.int64)


# ---------------------------------------------------------------- sums over all vectors

def _total(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of of(y) over all blocks: added up in each task, then by Spark."""
    names = [f"c{i}" for i in range(shape[1])]

    def run(batches):
        found = None
        for y in _matrices(batches):
            got = of(y)
            found = got if found is None else found + got
        if found is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shape[0]), pa.int32()), *(pa.array(found[:, i]) for i in range(shape[1]))],
                names=["j", *names])

    parts = blocks.select("dim", "width", "y").mapInArrow(run, "j int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros(shape)
    for row in parts.groupBy("j").agg(*(F.sum(c).alias(c) for c in names)).collect():
        out[row.j] = row[1:]
    return out


def _moments(blocks: DataFrame) -> tuple[int, list[int], list[int]]:
    """n, and per dimension the exact sums of y and of y squared."""
    def run(batches):
        n, s, q = 0, None, None
        for y in _matrices(batches):
            exact = y if np.abs(y).max() < 1 << 24 else y.astype(object)
            n += len(y)
            new = y.sum(axis=0).tolist(), (exact * exact).sum(axis=0).tolist()
            s = new[0] if s is None else [a + b for a, b in zip(s, new[0])]
            q = new[1] if q is None else [a + b for a, b in zip(q, new[1])]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(s)), pa.int32()), pa.array([n] * len(s), pa.int64()),
                 *(pa.array([Decimal(int(v)) for v in x], pa.decimal128(38, 0)) for x in (s, q))],
                names=["j", "n", "s", "q"])

    parts = blocks.select("dim", "width", "y").mapInArrow(run, "j int, n bigint, s decimal(38,0), q decimal(38,0)")
    rows = parts.groupBy("j").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q"))).orderBy("j").collect()
    return (rows[0].n if rows else 0), [int(r.s) for r in rows], [int(r.q) for r in rows]


# ---------------------------------------------------------------- Jacobi-Davidson

def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=0))


def _over(a, b):
    return np.divide(a, b, out=np.zeros_like(a), where=b != 0)


def minres(op: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, rtol: float) -> np.ndarray:
    """Approximate solutions of op(t) = rhs for all columns at once. The columns
    keep recurrences of their own and share each product."""
    x, v_old, w, w_old = (np.zeros_like(rhs) for _ in range(4))
    beta = _norms(rhs)
    first, eta = beta, beta.copy()
    v = _over(rhs, np.broadcast_to(beta, rhs.shape))
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    for _ in range(steps):
        p = op(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = _norms(p)
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old = c, s
        c, s = _over(delta, rho1), _over(beta_new, rho1)
        w, w_old = _over(v - rho3 * w_old - rho2 * w, np.broadcast_to(rho1, rhs.shape)), w
        x = x + c * eta * w
        eta = -s * eta
        v_old, v = v, _over(p, np.broadcast_to(beta_new, rhs.shape))
        beta = beta_new
        if (np.abs(eta) <= rtol * first).all():
            break
    return x


def _fresh_directions(t: np.ndarray, *known: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what t adds to the known ones."""
    t = _over(t, np.broadcast_to(_norms(t), t.shape))
    for _ in range(3):
        for k in known:
            t = t - k @ (k.T @ t)
        u, sizes, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, sizes > 1e-10]
    return t


@dataclass
class Eigen:
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    residuals: np.ndarray
    products: int = 0  # distributed products used


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, k: int, inner: int = 4,
                    basis: int = 12, rounds: int = 200, seed: int = 7) -> Eigen:
    """The k leading eigenpairs of a symmetric product. The search space is
    restarted from its best Ritz vectors beyond ``basis * k`` columns; a pair
    whose residual has met double precision, and all larger ones', is locked."""
    k, used = min(k, dim), 0

    def apply(p):
        nonlocal used
        used += 1
        return product(p)

    locked = np.zeros((dim, 0))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, k)))[0]
    aq = apply(q)
    top, last = 0.0, []
    for turn in range(rounds):
        h = q.T @ aq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        want = min(k - locked.shape[1], len(theta))
        q, aq = q @ s, aq @ s
        top = max(top, abs(theta[0]))
        r = aq[:, :want] - q[:, :want] * theta[:want]
        r -= locked @ (locked.T @ r)
        size = _norms(r)
        whole = locked.shape[1] + q.shape[1] == dim  # nothing is left outside the search space
        stuck = len(last) > 1 and size.max() <= FLOOR * top and size.max() > 0.5 * min(last[-2:])
        done = size <= REACHED * top if not (whole or stuck) else np.ones(want, bool)
        met = int(np.argmin(done)) if not done.all() else want
        if met:
            locked = np.linalg.qr(np.hstack([locked, q[:, :met]]))[0]
            q, aq, theta, r, last = q[:, met:], aq[:, met:], theta[met:], r[:, met:], []
        else:
            last.append(size.max())
        if locked.shape[1] == k:
            break
        u, values = q[:, :want - met], theta[:want - met]
        w = np.hstack([locked, u])

        def projected(p):
            p = p - w @ (w.T @ p)
            p = apply(p) - p * values
            return p - w @ (w.T @ p)

        t = minres(projected, -r, inner, rtol=max(1e-3, 0.3 ** (turn + 1)))
        if q.shape[1] + t.shape[1] > basis * k:
            q, aq = q[:, :2 * k], aq[:, :2 * k]
        t = _fresh_directions(t, locked, q)
        if not t.shape[1]:  # the corrections lie in the space already: widen it at random
            t = _fresh_directions(np.random.default_rng(seed + turn + 1).standard_normal((dim, k)), locked, q)
        q, aq = np.hstack([q, t]), np.hstack([aq, apply(t)])
    else:
        raise ArithmeticError(f"residuals {size / top} after {rounds} rounds")
    # one more Rayleigh-Ritz over all locked vectors: order and eigenvalues of the whole set
    al = apply(locked)
    h = locked.T @ al
    theta, s = np.linalg.eigh((h + h.T) / 2)
    theta, s = theta[::-1], s[:, ::-1]
    vectors = locked @ s
    return Eigen(theta, vectors, _norms(al @ s - vectors * theta), used)


# ---------------------------------------------------------------- the operator

@dataclass
class Whitening:
    n: int
    sums: list[int]  # of y, by dimension
    trace: float
    eigen: Eigen
    identity_error: float | None = field(default=None)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # of integers: rounded once

    @property
    def projection(self) -> np.ndarray:
        return self.eigen.vectors / np.sqrt(self.eigen.values)


def fit_whitening(blocks: DataFrame, k: int = 8) -> Whitening | None:
    """The whitening of all staged vectors; None where there are none."""
    n, s, q = _moments(blocks)
    if not n:
        return None
    dim = len(s)
    trace = sum(n * b - a * a for a, b in zip(s, q)) / (n * n)
    mean = np.array([a / n for a in s])

    def product(p):
        def part(y):
            centred = y - mean
            return centred.T @ (centred @ p)
        return _total(blocks, part, p.shape) / n

    if trace == 0:
        return Whitening(n, s, 0.0, Eigen(*(np.zeros(x) for x in (0, (dim, 0), 0))))
    eigen = jacobi_davidson(product, dim, k)
    some = eigen.values > dim * EPS * eigen.values[0] * 16
    eigen = Eigen(eigen.values[some], eigen.vectors[:, some], eigen.residuals[some], eigen.products)
    model = Whitening(n, s, trace, eigen)
    to = model.projection

    def gram(y):
        w = np.hstack([(y - mean) @ to, np.ones((len(y), 1))])
        return w.T @ w

    total = _total(blocks, gram, (to.shape[1] + 1,) * 2) / n
    centre = total[:-1, -1]
    model.identity_error = float(np.abs(total[:-1, :-1] - np.outer(centre, centre) - np.eye(len(centre))).max())
    return model


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n y - S)**2, exact."""
    most = n * float(np.abs(y).max()) + max(map(abs, sums))
    if most * most * y.shape[1] < 2.0 ** 62:
        gap = n * y - np.array(sums)
        return (gap * gap).sum(axis=1).tolist()
    gap = n * y.astype(object) - np.array(sums, object)
    return [int(v) if v < 1 << 63 else None for v in (gap * gap).sum(axis=1)]


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def apply_whitening(blocks: DataFrame, model: Whitening | None) -> DataFrame:
    """A row for each staged vector and component."""
    if model is None:
        return blocks.sparkSession.createDataFrame([], OUT)
    mean, to = model.mean, model.projection
    k = to.shape[1]
    share = model.eigen.values / model.trace if model.trace else model.eigen.values

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for known, y in zip(ids, _matrices([batch])):
                m = len(y)
                dev = pa.array(deviations(y, model.n, model.sums), pa.int64())
                row = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.as_py(), pa.int64()).take(row), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, model.n), pa.int64()), dev.take(row),
                     pa.array(((y - mean) @ to).ravel()), pa.array(np.tile(share, m)),
                     pa.array(np.full(m * k, np.nan if model.identity_error is None else model.identity_error))],
                    names=[c.split()[0] for c in OUT.split(", ")])

    return blocks.mapInArrow(run, OUT)


def whiten(vectors: DataFrame, k: int = 8, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component (1 to k), n, deviation, whitened, explained and
    identity_error for every valid vector."""
    blocks = stage(vectors, vec_id, embedding)
    return apply_whitening(blocks, fit_whitening(blocks, k))
