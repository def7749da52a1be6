"""Embedding whitening by incremental eigendecomposition.

Each partition of the distinct vectors holds spectra (eigenvalues and eigenvectors of the centred scatter so far) and adds every
vector as one centred rank-one update: the new eigenvalues are the roots of the secular equation
``1 + sum b_i / (l_i - x) = 0``, found between neighbouring poles by two-pole rational steps inside a bracket; weights
that are negligible and eigenvalues that coincide are deflated first; the eigenvectors follow from the weights that the found roots belong to
exactly, so they stay orthogonal.  A task runs ``STREAMS`` spectra in step, so that numpy works on blocks.  Spectra are
combined by adding one's eigenpairs, and the difference of the means, to the other as successive rank-one
updates: inside a task, then over groups of ``FAN_IN`` spectra.  At the end distributed Rayleigh-Ritz passes project the covariance
on the combined basis, which covers the whole space, and turn it to eigenvectors in double precision.

Entries are read as whole numbers ``floor(64 * c) + 1000000``.  Rows travel as these numbers (without the constant shift) in as few bytes
as the row needs.  Only spectra, sums and matrices of the dimension are collected or broadcast, never rows.

Edge cases: vectors that are null, empty, or hold null or non-finite entries are left out; so are vectors of another
length than the commonest one (of equals the longer); ids may be null or repeated and each row gets its own result; ``64 * c``
beyond 2**52 counts as 2**52; without rows the result is empty; a component without variance (eigenvalue not above
rounding) has null ``whitened`` and stays out of ``identity_error``; a deviation too large for a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import stage

#: entries are ``floor(SCALE * c) + SHIFT``; the shift changes neither deviations nor covariances
SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 52)
#: spectra that a task updates in step, and spectra that are combined in one group
STREAMS = 16
FAN_IN = 16
#: weights and gaps below this part of the largest eigenvalue are deflated
DEFLATE = 1e-14
#: a component's eigenvalue must exceed this part of the largest one
NO_VARIANCE = 1e-12
STEPS = 40
SPECTRUM = "key int, n long, mean binary, values binary, vectors binary"


# rows ---------------------------------------------------------------------------------------

def encode(x: np.ndarray) -> list[bytes]:
    """Rows of whole numbers, each in the fewest bytes an entry (1, 2, 4 or 8; the first byte says which)."""
    most = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1))
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        part = x[at].astype(f"<i{w}")
        for k, row in zip(at, part):
            out[k] = bytes([w]) + row.tobytes()
    return out


def decode(column: pa.Array, dim: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.empty((len(rows), dim), np.int64)
    width = np.array([r[0] for r in rows], np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join(rows[k][1:] for k in at), f"<i{w}").reshape(-1, dim)
    return out


def _whole_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole numbers) of the usable vectors of a list column, by length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.asarray(lists.offsets).astype(np.int64)
    values = np.asarray(lists.values.cast(pa.float64()).fill_null(np.nan))
    sizes = np.where(np.asarray(lists.is_valid()), np.diff(ends), 0)
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        x = values[ends[at][:, None] + np.arange(size)]
        fine = np.isfinite(x).all(axis=1)
        yield at[fine], np.clip(np.floor(np.clip(x[fine], -LIMIT, LIMIT) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def coded_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, length and coded whole numbers of every usable row."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, x in _whole_vectors(batch.column(1)):
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1], np.int32)),
                                                      pa.array(encode(x), pa.binary())], names=["id", "dim", "x"])

    return stage(kept.mapInArrow(run, f"id {kind}, dim int, x binary"), "whiten-rows")


# rank-one updates ---------------------------------------------------------------------------

def _deflate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, gap: np.ndarray) -> None:
    """Where neighbouring eigenvalues coincide, rotate their vectors so that only the upper one carries weight."""
    for j in range(values.shape[1] - 1):
        on = np.flatnonzero((values[:, j + 1] - values[:, j] <= gap) & (z[:, j] != 0))
        if len(on):
            r = np.hypot(z[on, j], z[on, j + 1])
            c, s = z[on, j + 1] / r, z[on, j] / r
            low, high = vectors[on, :, j].copy(), vectors[on, :, j + 1].copy()
            vectors[on, :, j + 1] = c[:, None] * high + s[:, None] * low
            vectors[on, :, j] = c[:, None] * low - s[:, None] * high
            z[on, j], z[on, j + 1] = 0, r


def secular_roots(values: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots x_j of ``1 + sum_i b_i / (values_i - x) = 0`` for each row of ascending poles (b > 0 active, 0 deflated).

    Returns the roots (a deflated pole stands for itself) and the differences ``values_i - x_j``, accurate next to either pole."""
    m, d = values.shape
    active = b > 0
    upper = np.where(active, values, np.inf)
    upper = np.concatenate([np.minimum.accumulate(upper[:, ::-1], axis=1)[:, ::-1][:, 1:], np.full((m, 1), np.inf)], axis=1)
    last = active & np.isinf(upper)
    total = b.sum(axis=1, keepdims=True)
    upper = np.where(last, values + total, np.where(active, upper, values))
    width = upper - values
    weight = b[:, :, None]

    def parts(delta):
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(weight > 0, weight / delta, 0)
            return t, np.where(weight > 0, t / delta, 0)

    # the nearer pole is the origin; a last root is always taken from its own pole
    t, _ = parts(values[:, :, None] - (values + width / 2)[:, None, :])
    left = (1 + t.sum(axis=1) >= 0) | last
    origin = np.where(left, values, upper)
    away = values[:, :, None] - origin[:, None, :]
    lo, hi = np.where(left, 0, -width / 2), np.where(left, np.where(last, width, width / 2), 0)
    x = (lo + hi) / 2
    below = np.tril(np.ones((d, d), bool)).T[None]  # poles up to the root's own
    own, other = values - origin, np.where(last, 0, upper - origin)
    for _ in range(STEPS):
        t, slope = parts(away - x[:, None, :])
        f = 1 + t.sum(axis=1)
        size = 1 + np.abs(t).sum(axis=1)
        open_ = active & (np.abs(f) > 4e-16 * d * size) & (hi - lo > 4e-16 * np.maximum(np.abs(lo), np.abs(hi)))
        if not open_.any():
            break
        lo, hi = np.where(open_ & (f < 0), x, lo), np.where(open_ & (f > 0), x, hi)
        d1, d2 = own - x, other - x
        s = slope.sum(axis=1)
        s1 = np.where(below, slope, 0).sum(axis=1)
        with np.errstate(all="ignore"):
            c = f - d1 * s1 - d2 * (s - s1)
            p, q = (d1 + d2) * f - d1 * d2 * s, d1 * d2 * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step = np.where(last, d1 + d1 * d1 * s / (f - d1 * s), step)
        new = x + step
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        x = np.where(open_, new, x)
    x = np.where(active, x, 0)
    return np.where(active, origin + x, values), away - x[:, None, :]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectra (m x d ascending, m x d x d) after adding ``rho v v'`` to each."""
    z = np.matmul(v[:, None, :], vectors)[:, 0, :] * np.sqrt(rho)[:, None]
    scale = np.maximum(values[:, -1], (z * z).sum(axis=1))
    gap = DEFLATE * scale
    if (values[:, 1:] - values[:, :-1] <= gap[:, None]).any():
        vectors = vectors.copy()
        _deflate_equal(values, vectors, z, gap)
    z = np.where(z * z <= gap[:, None] * DEFLATE, 0, z)
    b = z * z
    active = b > 0
    roots, away = secular_roots(values, b)
    both = active[:, :, None] & active[:, None, :]
    with np.errstate(all="ignore"):
        # weights whose roots are exactly the found ones
        poles = values[:, :, None] - values[:, None, :]
        same = np.eye(values.shape[1], dtype=bool)[None]
        ratio = np.where(both, np.where(same, -away, away / np.where(same, 1, poles)), 1)
        z = np.where(active, np.copysign(np.sqrt(np.abs(ratio.prod(axis=2))), z), 0)
        turn = np.where(both, z[:, :, None] / away, 0)
        turn /= np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    turn = np.where(active[:, None, :], turn, same)
    vectors = np.matmul(vectors, turn)
    order = np.argsort(roots, axis=1, kind="stable")
    if (order[:, 1:] < order[:, :-1]).any():
        roots = np.take_along_axis(roots, order, axis=1)
        vectors = np.take_along_axis(vectors, order[:, None, :], axis=2)
    return np.maximum(roots, 0), vectors


@dataclass
class Spectra:
    """Numbers of rows, means and centred scatter spectra of several sets of rows."""

    n: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, m: int, dim: int) -> Spectra:
        return cls(np.zeros(m), np.zeros((m, dim)), np.zeros((m, dim)), np.broadcast_to(np.eye(dim), (m, dim, dim)).copy())

    def add(self, x: np.ndarray, real: np.ndarray) -> None:
        """One row to each set (where ``real``), as a centred rank-one update."""
        off = np.where(real[:, None], x - self.mean, 0)
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n = self.n + real
        self.mean = self.mean + off / np.maximum(self.n, 1)[:, None]

    def pick(self, at) -> Spectra:
        return Spectra(self.n[at], self.mean[at], self.values[at], self.vectors[at])

    def combined(self, other: Spectra) -> Spectra:
        """Each set joined with the other's, by successive rank-one updates."""
        n = self.n + other.n
        values, vectors = self.values, self.vectors
        for j in range(values.shape[1]):
            values, vectors = rank_one(values, vectors, other.vectors[:, :, j], other.values[:, j])
        off = other.mean - self.mean
        safe = np.maximum(n, 1)
        values, vectors = rank_one(values, vectors, off, self.n * other.n / safe)
        return Spectra(n, self.mean + off * (other.n / safe)[:, None], values, vectors)

    def one(self) -> Spectra:
        """All sets in one."""
        s = self
        while len(s.n) > 1:
            half = len(s.n) // 2
            rest = s.pick(slice(2 * half, None))
            joined = s.pick(slice(0, half)).combined(s.pick(slice(half, 2 * half)))
            s = Spectra(*[np.concatenate([a, b]) for a, b in zip(vars(joined).values(), vars(rest).values())])
        return s


def spectrum_of(rows: np.ndarray, streams: int = STREAMS) -> Spectra:
    """The spectrum of a block of rows, added one by one to ``streams`` spectra that are then combined."""
    s = Spectra.empty(streams, rows.shape[1])
    for a in range(0, len(rows), streams):
        part = rows[a:a + streams]
        real = np.arange(streams) < len(part)
        s.add(np.concatenate([part, np.zeros((streams - len(part), rows.shape[1]))]), real)
    return s.one()


# distributed passes -------------------------------------------------------------------------

def _packed(key: int, s: Spectra) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"key": key, "n": int(s.n[0]), "mean": s.mean[0].tobytes(), "values": s.values[0].tobytes(),
                                        "vectors": np.ascontiguousarray(s.vectors[0]).tobytes()}],
                                      schema=pa.schema([("key", pa.int32()), ("n", pa.int64()), ("mean", pa.binary()), ("values", pa.binary()), ("vectors", pa.binary())]))


def _unpacked(r: dict) -> Spectra:
    d = len(r["mean"]) // 8
    return Spectra(np.array([float(r["n"])]), np.frombuffer(r["mean"]).reshape(1, d), np.frombuffer(r["values"]).reshape(1, d),
                   np.frombuffer(r["vectors"]).reshape(1, d, d))


def _join_group(rows: pa.Table) -> pa.Table:
    parts = [_unpacked(r) for r in sorted(rows.to_pylist(), key=lambda r: r["key"])]
    s = Spectra(*[np.concatenate(x) for x in zip(*[vars(p).values() for p in parts])]).one()
    return pa.Table.from_batches([_packed(rows["key"][0].as_py() // FAN_IN, s)])


def incremental_basis(fit: DataFrame, dim: int, origin: np.ndarray) -> np.ndarray:
    """Eigenvectors (columns, falling eigenvalue) of all rows of ``fit`` (x), by rank-one updates and combined spectra."""
    def run(batches):
        total = None
        for batch in batches:
            s = spectrum_of((decode(batch.column(0), dim) - origin).astype(np.float64))
            total = s if total is None else total.combined(s)
        if total is not None and total.n[0] > 0:
            yield _packed(TaskContext.get().partitionId(), total)

    spectra = stage(fit.mapInArrow(run, SPECTRUM), "whiten-spectra")
    while spectra.count() > 1:
        spectra = stage(spectra.groupBy(F.expr(f"key div {FAN_IN}")).applyInArrow(_join_group, SPECTRUM), "whiten-spectra")
    return _unpacked(spectra.first().asDict()).vectors[0][:, ::-1].copy()


def _sum_rows(rows: pa.Table) -> pa.Table:
    parts = sorted(rows.to_pylist(), key=lambda r: r["task"])
    total = np.sum([np.frombuffer(r["x"]) for r in parts], axis=0)
    return pa.table({"i": [parts[0]["i"]], "x": pa.array([total.tobytes()], pa.binary())}, schema=pa.schema([("i", pa.int32()), ("x", pa.binary())]))


def projected_covariance(fit: DataFrame, dim: int, n: int, origin: np.ndarray, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of all rows, centred and projected on the columns of ``basis``: one distributed pass."""
    shared = fit.sparkSession.sparkContext.broadcast((origin, mean, basis))

    def run(batches):
        o, m, w = shared.value
        total = np.zeros((w.shape[1], w.shape[1]))
        for batch in batches:
            p = ((decode(batch.column(0), dim) - o) - m) @ w
            total += p.T @ p
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), task, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)),
                                          pa.array([row.tobytes() for row in total], pa.binary())], names=["task", "i", "x"])

    rows = fit.mapInArrow(run, "task int, i int, x binary").groupBy("i").applyInArrow(_sum_rows, "i int, x binary").collect()  # a dim x dim matrix
    out = np.stack([np.frombuffer(r.x) for r in sorted(rows)]) / n
    return (out + out.T) / 2


def rayleigh_ritz(covariance: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors from the covariance projected on an orthonormal basis."""
    values, turn = np.linalg.eigh(covariance)
    return values[::-1], basis @ turn[:, ::-1]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact sums, and the leading components (columns) with their eigenvalues."""

    dim: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def origin(self) -> np.ndarray:
        return np.array([round(s / self.n) for s in self.sums], np.int64)

    @property
    def mean(self) -> np.ndarray:
        """Means less the origin."""
        return np.array([(s - self.n * o) / self.n for s, o in zip(self.sums, self.origin.tolist())])


def _exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    def run(batches):
        n, sums = 0, [0] * dim
        for batch in batches:
            x = decode(batch.column(0), dim)
            high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
            sums = [s + (h << 26) + v for s, h, v in zip(sums, high, low)]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dim, dtype=np.int32)), pa.array([Decimal(s) for s in [n, *sums]], pa.decimal128(30, 0))],
                                         names=["i", "s"])

    rows = dict(fit.mapInArrow(run, "i int, s decimal(30,0)").groupBy("i").agg(F.sum("s")).collect())  # one row a dimension
    return int(rows.get(-1, 0)), [int(rows.get(i, 0)) for i in range(dim)]


def fit_whitening(coded: DataFrame, components: int = 16, passes: int = 2) -> tuple[Whitening | None, DataFrame]:
    """The whitening of coded rows (id, dim, x) of the commonest length, and these rows."""
    lengths = coded.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    if lengths is None:
        return None, coded
    dim = lengths.dim
    rows = coded.where(F.col("dim") == dim)
    fit = stage(rows.select("x").distinct(), "whiten-fit")
    n, sums = _exact_sums(fit, dim)
    blank = Whitening(dim, n, tuple(sums), np.zeros(0), np.zeros((dim, 0)), 0.0, 0.0)
    origin, mean = blank.origin, blank.mean
    vectors = np.linalg.qr(incremental_basis(fit, dim, origin))[0]
    for _ in range(passes):
        covariance = projected_covariance(fit, dim, n, origin, mean, vectors)
        values, vectors = rayleigh_ritz(covariance, vectors)
    trace = float(np.trace(covariance))
    values, vectors = values[:components], vectors[:, :components]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0) < 0, -1, 1)
    some = values > NO_VARIANCE * max(values[0], 0)
    error = 0.0
    if some.any():
        white = projected_covariance(fit, dim, n, origin, mean, vectors[:, some] / np.sqrt(values[some]))
        error = float(np.abs(white - np.eye(some.sum())).max())
    return Whitening(dim, n, tuple(sums), values, vectors, trace, error), rows


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums over dimensions of ``(n x - S)^2``; None where that exceeds a long."""
    about = ((float(n) * x - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    low = np.array([s & (2**64 - 1) for s in sums], np.uint64).view(np.int64)
    with np.errstate(over="ignore"):
        off = np.int64(n) * x - low
        out: list[int | None] = (off * off).sum(axis=1).tolist()  # exact where the true value is a long
    for k in np.flatnonzero(about > 2.0**62):
        v = sum((n * c - s) ** 2 for c, s in zip(x[k].tolist(), sums))
        out[k] = v if v < 2**63 else None
    return out


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable row and component: whitened value, explained share, and the fit's figures."""
    coded = coded_rows(vectors, id_col, vector_col)
    kind = coded.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model, rows = fit_whitening(coded, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        k = len(m.values)
        some = m.values > NO_VARIANCE * max(m.values[0], 0)
        scale = np.where(some, m.vectors / np.sqrt(np.where(some, m.values, 1)), np.nan)
        share = m.values / m.trace if m.trace > 0 else np.zeros(k)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x = decode(part.column(1), m.dim)
                white = ((x - m.origin) - m.mean) @ scale
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, m.n, np.int64)),
                    pa.array(deviations(x, m.n, m.sums), pa.int64()).take(at), pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    pa.array(np.tile(share, len(x))), pa.array(np.full(len(x) * k, m.identity_error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, schema)
