"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes.

The covariance V of a table of vectors is never formed. A pass multiplies a thin block
Q by it: every task sums (x - m)((x - m)'Q) over its rows, with m the exact mean. A
Chebyshev recurrence over such passes damps the directions whose eigenvalues lie in an
interval below the wanted ones; QR and Rayleigh-Ritz then turn the block towards the
eigenvectors, and rounds go on until the residuals certify them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import new_folder, staged

COMPONENTS = 32
#: Vectors that the block has above the wanted ones; unwanted eigenvalues are those behind them.
GUARD = 16
DEGREE = 10
#: A filter raises the largest eigenvalue at most so much over the least wanted one.
MOST_SPREAD = 1e8
#: Residuals, as shares of the largest eigenvalue, that count as converged and at which a
#: column is left out of further filters.
CERTIFIED, LOCKED = 1e-13, 2e-14
#: Rounds without success after which the block grows; a block of all dimensions is exact.
ROUNDS = 12
#: Eigenvalues below this share of the largest one are zero: nothing to whiten.
RANK = 1e-11
#: Numbers of a batch that are turned into doubles at once.
PIECE = 1 << 21
SCALE, SHIFT = 64.0, 1_000_000
_STAGED = "vec_id bigint, dim int, width int, data binary"


# Rows are staged as the little-endian integers floor(64 c) in the narrowest type that
# holds the row; the shift of x is added back only where x itself is asked for.
def _integers(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors, ids = batch.column(column), batch.column("vec_id")
        sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == dim)
            step = max(1, PIECE // dim)
            for at in range(0, len(rows), step):
                some = pa.array(rows[at : at + step])
                flat = vectors.take(some).flatten().cast(pa.float64())
                x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
                with np.errstate(invalid="ignore", over="ignore"):
                    y = np.floor(SCALE * x)
                    good = (np.abs(y) < 2.0**62).all(axis=1)
                yield from _packed(ids.take(some).filter(pa.array(good)), y[good].astype(np.int64), dim)


def _packed(ids: pa.Array, y: np.ndarray, dim: int) -> Iterator[pa.RecordBatch]:
    most = np.maximum(y, ~y).max(axis=1) if len(y) else np.zeros(0, np.int64)
    width = np.where(most < 2**15, 2, np.where(most < 2**31, 4, 8))
    for w in (2, 4, 8):
        rows = np.flatnonzero(width == w)
        if len(rows):
            data = y[rows].astype(f"<i{w}").tobytes()
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * (w * dim)
            binary = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            sizes = [pa.array(np.full(len(rows), v, np.int32)) for v in (dim, w)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *sizes, binary], names=["vec_id", "dim", "width", "data"])


def _matrices(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows of one width, with their integers."""
    widths = batch.column("width").to_numpy()
    cuts = np.flatnonzero(np.diff(widths)) + 1
    step = max(1, PIECE // dim)
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        for at in range(a, b, step):
            rows = batch.slice(at, min(step, b - at))
            data = rows.column("data").cast(pa.large_binary())
            first = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset]
            y = np.frombuffer(data.buffers()[2], dtype=f"<i{widths[a]}", count=rows.num_rows * dim, offset=int(first))
            yield rows, y.reshape(-1, dim)


def _exact_sum(y: np.ndarray) -> list[int]:
    """Column sums as Python integers: as longs where they fit for certain."""
    most = max(int(y.max()), -int(y.min())) * len(y)
    return (y.astype(np.int64) if most < 2**62 else y.astype(object)).sum(axis=0).tolist()


def _totals(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """``place, high, low``: exact sums of entries (by dimension) and, at place ``dim``, of squares."""
    total = [0] * (dim + 1)
    for batch in batches:
        for _, y in _matrices(batch, dim):
            for i, s in enumerate(_exact_sum(y)):
                total[i] += s
            wide = y.astype(np.int64)
            if int(np.abs(wide).max()) < 2**20:
                total[dim] += int((wide * wide).sum())
            else:
                total[dim] += int((y.astype(object) ** 2).sum())
    parts = [divmod(t, 1 << 40) for t in total]
    digits = [[p[0] >> 40, p[0] & ((1 << 40) - 1), p[1]] for p in parts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(dim + 1), pa.int64()), *(pa.array([d[k] for d in digits], pa.int64()) for k in range(3))],
        names=["place", "a", "b", "c"],
    )


def _sums_of(rows: DataFrame, of, names: int) -> np.ndarray:
    """Element-wise sums of what the tasks yield as (place, value); the driver gets one
    row per place, never anything that grows with the rows."""
    parts = rows.select("width", "data").mapInArrow(of, "place bigint, value double")
    table = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(names)
    out[table.column("place").to_numpy()] = table.column("value").to_numpy()
    return out


def _places(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])


def _multiplied(batches: Iterator[pa.RecordBatch], mean: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = np.zeros(block.shape)
    for batch in batches:
        for _, y in _matrices(batch, len(mean)):
            centred = y - mean
            total += centred.T @ (centred @ block)
    yield _places(total)


def _second_moments(batches: Iterator[pa.RecordBatch], mean: np.ndarray, scaled: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of products of whitened values, and of the values in the last row."""
    k = scaled.shape[1]
    total = np.zeros((k + 1, k))
    for batch in batches:
        for _, y in _matrices(batch, len(mean)):
            white = (y - mean) @ scaled
            total[:k] += white.T @ white
            total[k] += white.sum(axis=0)
    yield _places(total)


@dataclass(frozen=True)
class Fit:
    """What a whitening is: eigenpairs of the covariance of ``n`` vectors and their certificates."""

    n: int
    dim: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


class _Covariance:
    """Products with the covariance of the staged rows, a pass over them each."""

    def __init__(self, rows: DataFrame, n: int, mean: np.ndarray) -> None:
        self.rows, self.n, self.mean, self.passes = rows, n, mean, 0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        self.passes += 1
        of = partial(_multiplied, mean=self.mean, block=np.ascontiguousarray(block))
        return _sums_of(self.rows, of, block.size).reshape(block.shape) / self.n


def _ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors, their images and residual norms."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, images = basis @ turn, image @ turn
    return values, vectors, images, np.linalg.norm(images - vectors * values, axis=0)


def _degree(top: float, least: float) -> int:
    """The filter's degree: its spread over the wanted eigenvalues (at ``top`` and ``least``,
    in units of the damped interval) stays small enough for QR to see all columns."""
    apart = np.arccosh(max(top, 1.0)) - np.arccosh(max(least, 1.0))
    return DEGREE if apart * DEGREE <= np.log(MOST_SPREAD) else max(2, int(np.log(MOST_SPREAD) / apart))


def eigenpairs(times, dim: int, wanted: int, guard: int = GUARD) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenpairs of the symmetric positive semidefinite operator
    ``times`` (block to block), and the largest residual over the largest eigenvalue.

    A start vector of its own runs through the passes of the first filter as a Lanczos
    process: its Ritz value less its residual bounds the spectrum from below, so later
    filters damp the interval between that bound and the smallest Ritz value of the block.
    Should a Ritz value fall below the bound, the bound gives way. Converged columns leave
    the filter and are projected out of the others. A block that does not get there in
    some rounds grows, at the latest to all dimensions, where Rayleigh-Ritz is exact.
    """
    random = np.random.default_rng(64)
    size = min(dim, wanted + guard)
    values, vectors, images, errors = _ritz(*_applied(times, np.linalg.qr(random.standard_normal((dim, size)))[0]))
    low, lanczos, rounds = 0.0, _Lanczos(random.standard_normal(dim)), 0
    while True:
        scale = max(values[0], 0.0)
        worst = float(errors[:wanted].max()) / scale if scale else 0.0
        if size == dim or worst <= CERTIFIED or values[-1] <= RANK * scale and errors.max() <= RANK * scale:
            return values[:wanted], vectors[:, :wanted], worst
        rounds += 1
        if rounds % ROUNDS == 0:
            size = min(dim, size + guard)
            more = random.standard_normal((dim, size - vectors.shape[1]))
            values, vectors, images, errors = _ritz(*_applied(times, np.linalg.qr(np.hstack([vectors, more]))[0]))
            continue
        locked = 0
        while locked < wanted and errors[locked] <= LOCKED * scale:
            locked += 1
        kept, kept_image = vectors[:, :locked], images[:, :locked]
        low = min(low, values[-1])
        block = _filtered(times, vectors[:, locked:], images[:, locked:], kept, values[locked:], low, values[min(wanted, size) - 1], lanczos)
        low = max(low, lanczos.bound())
        block, _ = np.linalg.qr(block - kept @ (kept.T @ block))
        block, _ = np.linalg.qr(block - kept @ (kept.T @ block))
        image = times(block)
        values, vectors, images, errors = _ritz(np.hstack([kept, block]), np.hstack([kept_image, image]))


def _applied(times, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return basis, times(basis)


def _filtered(times, block, image, kept, values, low, least, lanczos) -> np.ndarray:
    """The Chebyshev polynomial of the interval from ``low`` to the block's smallest value,
    applied to ``block`` by its three-term recurrence, scaled to be 1 at the largest value.
    ``image`` is the operator's product with ``block``, so the first term costs no pass."""
    high = max(values[-1], low)
    half, centre = (high - low) / 2, (high + low) / 2
    if half <= 1e-12 * values[0]:
        return image
    degree = _degree((values[0] - centre) / half, (least - centre) / half)
    first = half / (values[0] - centre)
    sigma = first
    before, now = block, (image - centre * block) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        product = lanczos.beside(times, now)
        before, now = now, (product - centre * now) * (2 * after / half) - before * (sigma * after)
        now = now - kept @ (kept.T @ now)
        sigma = after
    return now


class _Lanczos:
    """A Lanczos process that takes its products beside those of a block, until the first
    filter is through."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis = [start / np.linalg.norm(start)]
        self.diagonal: list[float] = []
        self.off: list[float] = []

    def beside(self, times, block: np.ndarray) -> np.ndarray:
        if len(self.diagonal) >= DEGREE - 1 or self.off and self.off[-1] < 1e-12:
            return times(block)
        both = times(np.column_stack([block, self.basis[-1]]))
        w, q = both[:, -1], np.column_stack(self.basis)
        self.diagonal.append(float(w @ self.basis[-1]))
        for _ in range(2):
            w = w - q @ (q.T @ w)
        self.off.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.off[-1] if self.off[-1] else w)
        return both[:, :-1]

    def bound(self) -> float:
        """Below the smallest eigenvalue, as far as the process has come."""
        if not self.diagonal:
            return 0.0
        inner = self.off[:-1]
        small = np.diag(self.diagonal) + np.diag(inner, 1) + np.diag(inner, -1)
        return max(0.0, float(np.linalg.eigvalsh(small)[0]) - self.off[-1])


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Each column with its largest entry positive, so reruns agree."""
    at = np.argmax(np.abs(vectors), axis=0)
    return vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def fit(rows: DataFrame, n: int, dim: int, components: int = COMPONENTS) -> Fit:
    """Fits the staged ``rows`` of ``dim`` entries; exact sums first, then the passes."""
    parts = rows.select("width", "data").mapInArrow(partial(_totals, dim=dim), "place bigint, a bigint, b bigint, c bigint")
    summed = parts.groupBy("place").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in "abc")).collect()
    total = {r["place"]: (int(r["a"]) << 80) + (int(r["b"]) << 40) + int(r["c"]) for r in summed}
    sums = [total[i] for i in range(dim)]
    trace = float(Fraction(n * total[dim] - sum(s * s for s in sums), n * n))
    mean = np.array([float(Fraction(s, n)) for s in sums])
    times = _Covariance(rows, n, mean)
    shifted = tuple(s + n * SHIFT for s in sums)
    if trace <= 0:
        return Fit(n, dim, shifted, trace, np.zeros(0), np.zeros((dim, 0)), 0.0, 0.0, 0)
    values, vectors, residual = eigenpairs(times, dim, min(components, dim))
    rank = int((values > RANK * values[0]).sum())
    values, vectors = values[:rank], _signed(vectors[:, :rank])
    scaled = vectors / np.sqrt(values)
    moments = _sums_of(rows, partial(_second_moments, mean=mean, scaled=scaled), (rank + 1) * rank).reshape(rank + 1, rank) / n
    error = float(np.abs(moments[:rank] - np.outer(moments[rank], moments[rank]) - np.eye(rank)).max())
    return Fit(n, dim, shifted, trace, values, vectors, residual, error, times.passes)


def _whitened(batches: Iterator[pa.RecordBatch], fitted: Fit) -> Iterator[pa.RecordBatch]:
    sums = [s - fitted.n * SHIFT for s in fitted.sums]
    mean = np.array([float(Fraction(s, fitted.n)) for s in sums])
    k = len(fitted.values)
    scaled = fitted.vectors / np.sqrt(fitted.values)
    shares = fitted.values / fitted.trace if k else fitted.values
    step = max(1, PIECE // max(1, 8 * k))
    for batch in batches:
        for rows, y in _matrices(batch, fitted.dim):
            deviation = _deviations(y, fitted.n, sums)
            white = (y - mean) @ scaled
            for at in range(0, len(y), step):
                part = white[at : at + step]
                each = pa.array(np.repeat(np.arange(at, at + len(part)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                        deviation.take(each), pa.array(part.ravel()), pa.array(np.tile(shares, len(part))),
                    ],
                    names=["vec_id", "component", "deviation", "whitened", "explained"],
                )


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n y - S)^2, exact: in longs where they suffice for certain."""
    most = n * max(int(y.max()), -int(y.min())) + max(map(abs, sums))
    if most * most * y.shape[1] < 2**63:
        apart = n * y.astype(np.int64) - np.array(sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    apart = n * y.astype(object) - np.array(sums, dtype=object)
    exact = (apart * apart).sum(axis=1).tolist()
    return pa.array([d if d < 10**38 else None for d in exact], pa.decimal128(38, 0))


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each
    usable row of ``vectors`` and each of the leading ``components``.

    Entries c become the integers floor(64 c) + 1000000. Components are unit eigenvectors
    of their covariance over all usable rows; ``whitened`` is the centred row projected on
    one, over the root of its eigenvalue; ``deviation`` (decimal) the exact squared distance
    of n times the row from the sum of all rows, null from 10^38 on. All rows are staged once
    as narrow integers; each pass reads them and sends one thin block per task to the shuffle.

    Rows whose vector is null, empty, or has a null or non-finite entry, or one whose
    integer exceeds 2^62, are left out; so are rows that have not the commonest number of
    entries (of equally common ones the largest). Repeated rows and ids and null ids count
    and come back as they are. Eigenvalues below 1e-11 of the largest are zero and
    have no component, so a table of one distinct vector, like an empty one, gives no rows.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    folder = new_folder(spark, "whitening")
    source = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).alias("vector"))
    rows = staged(source.mapInArrow(partial(_integers, column="vector"), _STAGED), folder, "rows")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    out = "vec_id bigint, component int, deviation decimal(38,0), whitened double, explained double"
    if sizes is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    rows = rows.where(F.col("dim") == sizes["dim"])
    fitted = fit(rows, sizes["n"], sizes["dim"], components)
    values = rows.select("vec_id", "width", "data").mapInArrow(partial(_whitened, fitted=fitted), out)
    return values.select(
        "vec_id", "component", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(fitted.identity_error).alias("identity_error"),
    )
