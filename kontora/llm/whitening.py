"""Whitened embeddings: leading eigenpairs of the covariance by spectrum slicing.

Spark sums the vectors and then the products of the centred vectors, so the driver sees only numbers per dimension and per pair of
dimensions. There the spectrum is sliced: the signs in an LDLᵀ factorization of the covariance less a shift say how many
eigenvalues lie above the shift, so halving intervals isolates each one with its number. Rayleigh quotient iteration then
converges to it within a few solves, and two more counts beside the result certify that it has the number it is given.

Entries are scaled and floored to integers, so counts, sums and squared deviations are exact whatever the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kontora.llm.common import stored

#: Components returned at most.
COMPONENTS = 32
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries of a matrix that a task holds at a time.
BLOCK = 1 << 19
_EPS = np.finfo(float).eps
_PIVOT = (1 + 17**0.5) / 8
_LOW = np.int64((1 << 31) - 1)


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``a`` exceed ``shift``: positive pivots of an LDLᵀ of a - shift I, with 1x1 and 2x2 pivots."""
    s, count = a - shift * np.eye(len(a)), 0
    while len(s):
        off = np.abs(s)
        diagonal = off.diagonal().copy()
        np.fill_diagonal(off, 0)
        p, (i, j) = int(diagonal.argmax()), np.unravel_index(int(off.argmax()), off.shape)
        if not max(diagonal[p], off[i, j]) > 0:
            return count
        pivot = [p] if diagonal[p] >= _PIVOT * off[i, j] else [i, j]
        rest = np.setdiff1d(np.arange(len(s)), pivot)
        block, side = s[np.ix_(pivot, pivot)], s[np.ix_(rest, pivot)]
        count += int(block[0, 0] > 0) if len(pivot) == 1 else 1  # a 2x2 pivot has one eigenvalue of either sign
        s = s[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return count


def isolated(a: np.ndarray, most: int, tight: float) -> list[tuple[float, float, int, int]]:
    """Intervals ``low, high, first, n`` that hold the eigenvalues numbered first to first + n - 1 from the top: one each, or
    several that lie within ``tight`` of each other. The ``most`` leading ones are covered."""
    edge = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9) + tight
    todo, out = [(-edge, edge, above(a, -edge), above(a, edge))], []
    while todo:
        low, high, upto, over = todo.pop()
        if upto == over or over >= most:
            continue
        if upto - over == 1 or high - low <= tight:
            out.append((low, high, over + 1, upto - over))
            continue
        mid = (low + high) / 2
        n = above(a, mid)
        todo += [(low, mid, upto, n), (mid, high, n, over)]
    return sorted(out, key=lambda x: x[2])


def _solve(a: np.ndarray, shift: float, x: np.ndarray, nudge: float) -> np.ndarray:
    for k in range(4):
        try:
            y = np.linalg.solve(a - (shift + k * nudge) * np.eye(len(a)), x)
            if np.isfinite(y).all():
                return y
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            pass
    return x


def rayleigh(a: np.ndarray, low: float, high: float, number: int, nudge: float) -> tuple[float, np.ndarray]:
    """The only eigenpair with its eigenvalue in (low, high]. A quotient that leaves the interval halves it by one more count."""
    rng = np.random.Generator(np.random.PCG64(number))
    while True:
        x = rng.standard_normal(len(a))
        for _ in range(2):
            x = _solve(a, (low + high) / 2, x / np.linalg.norm(x), nudge)
        x /= np.linalg.norm(x)
        value, rest = float(x @ a @ x), np.inf
        for _ in range(12):
            if not low - nudge <= value <= high + nudge:
                break
            now = float(np.linalg.norm(a @ x - value * x))
            if now <= len(a) * nudge and now >= rest / 2:  # cubic convergence has met the rounding
                return value, x
            rest = now
            y = _solve(a, value, x, nudge)
            x = y / np.linalg.norm(y)
            value = float(x @ a @ x)
        if high - low <= nudge:  # as narrow as doubles can tell: inverse iteration at its middle has found the vector
            return value, x
        mid = (low + high) / 2
        low, high = (mid, high) if above(a, mid) >= number else (low, mid)


def leading(a: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading positive eigenvalues of a covariance, falling, and their unit eigenvectors as columns; counts certify the numbers."""
    size = float(np.abs(a).sum(axis=1).max()) if a.size else 0.0
    if not size > 0:
        return np.zeros(0), np.zeros((len(a), 0))
    nudge, pairs = 4 * _EPS * size, []
    for low, high, first, n in isolated(a, most, 1e-12 * size):
        if n == 1:
            pairs.append(rayleigh(a, low, high, first, nudge))
            continue
        x = np.random.Generator(np.random.PCG64(first)).standard_normal((len(a), n))
        for _ in range(6):  # eigenvalues that cannot be told apart share a space
            x = np.linalg.qr(_solve(a, (low + high) / 2 + nudge, x, nudge))[0]
        values, turn = np.linalg.eigh(x.T @ a @ x)
        pairs += [(float(v), x @ t) for v, t in zip(values[::-1], turn.T[::-1])]
    values, vectors = np.array([v for v, _ in pairs]), np.stack([x for _, x in pairs], axis=1)
    start = 0
    for k in range(1, len(values) + 1):  # neighbours this close are made orthogonal within their common space
        if k < len(values) and values[k - 1] - values[k] < 1e-6 * size:
            continue
        if k - start > 1:
            q = np.linalg.qr(vectors[:, start:k])[0]
            part, turn = np.linalg.eigh(q.T @ a @ q)
            values[start:k], vectors[:, start:k] = part[::-1], (q @ turn)[:, ::-1]
        start = k
    values, vectors = values[:most], vectors[:, :most]
    for k, value in enumerate(values):
        slack = float(np.linalg.norm(a @ vectors[:, k] - value * vectors[:, k])) + len(a) * nudge
        if above(a, value + slack) > k or above(a, value - slack) < k + 1:
            raise ArithmeticError(f"eigenvalue {k + 1} is not the one counted")
    real = values > 2 * len(a) * nudge
    return values[real], vectors[:, real]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer entries of the usable vectors, one length at a time and some rows at a time."""
    lists = batch.column("v")
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), -1))
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), max(1, BLOCK // size)):
            some = rows[at : at + max(1, BLOCK // size)]
            c = lists.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) * SCALE  # a null is NaN
            good = (np.abs(c) < float(1 << 61)).all(axis=1)
            if good.any():
                yield some[good], np.floor(c[good]).astype(np.int64) + OFFSET


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for _, x in _vectors(batch):
            n, high, low = totals.get(x.shape[1], (0, 0, 0))
            totals[x.shape[1]] = n + len(x), high + (x >> 31).sum(axis=0), low + (x & _LOW).sum(axis=0)
    for size, (n, high, low) in totals.items():
        yield _table(size=np.full(size, size), dim=np.arange(size), n=np.full(size, n), high=high, low=low)


@dataclass
class Space:
    """``n`` vectors with sums ``total`` per dimension; entries are held less ``near``, the mean rounded to an integer."""

    n: int
    total: list[int]

    def __post_init__(self):
        self.dims = len(self.total)
        self.near = np.array([(2 * s + self.n) // (2 * self.n) for s in self.total], np.int64)
        self.left = np.array([s - self.n * int(r) for s, r in zip(self.total, self.near)], np.int64)  # at most n / 2

    def centred(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for rows, x in _vectors(batch):
            if x.shape[1] == self.dims:
                yield rows, x - self.near

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null beyond a long."""
        most = float(np.abs(y).max(initial=0)) * self.n + float(np.abs(self.left).max(initial=0))
        if most * most * self.dims < float(1 << 62):
            return ((y * self.n - self.left) ** 2).sum(axis=1).tolist()
        exact = ((y.astype(object) * self.n - self.left.astype(object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact]


def _products(blocks: Iterator[np.ndarray], dims: int) -> Iterator[pa.RecordBatch]:
    """Sums of products of any two columns, ``i <= j``."""
    total = np.zeros((dims, dims))
    for block in blocks:
        total += block.T @ block
    i, j = np.triu_indices(dims)
    yield _table(i=i, j=j, s=total[i, j])


def _gathered(rows: DataFrame, fn, dims: int) -> np.ndarray:
    """The symmetric matrix of the products that ``fn`` gives per task, added up by Spark."""
    out = np.zeros((dims, dims))
    for r in rows.mapInArrow(fn, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # a number per pair of dimensions
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


@dataclass
class Whitener:
    space: Space
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def apply(self, y: np.ndarray) -> np.ndarray:
        return (y - self.space.left / self.space.n) @ (self.vectors / np.sqrt(self.values))


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> Whitener | None:
    """Mean and leading components of all usable vectors; None if there are none."""
    rows = _rows(vectors, id_col, vector_col)
    parts = rows.select("v").mapInArrow(_sums, "size long, dim long, n long, high long, low long").groupBy("size", "dim")
    wide = F.sum(F.col("high").cast("decimal(38,0)") * (1 << 31) + F.col("low"))
    sums = stored(parts.agg(F.sum("n").alias("n"), wide.cast("decimal(38,0)").alias("total")), "sums")
    chosen = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if chosen is None:
        return None
    space = Space(chosen.n, [int(r.total) for r in sums.filter(F.col("size") == chosen["size"]).orderBy("dim").collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _products((y.astype(float) for b in batches for _, y in space.centred(b)), space.dims)

    left = space.left.astype(float)
    v = (_gathered(rows.select("v"), run, space.dims) - np.outer(left, left) / space.n) / space.n
    values, directions = leading(v, most)
    return Whitener(space, values, directions, float(np.trace(v)))


def whitened(vectors: DataFrame, model: Whitener, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened`` (an array over the components) per usable vector of the model's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, y in model.space.centred(batch):
                w = model.apply(y)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                ids = batch.column("vec_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(model.space.deviations(y), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    return _rows(vectors, id_col, vector_col).mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitener, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened vectors less the identity, measured over all of them."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (model.apply(y) for b in batches for _, y in model.space.centred(b))
        yield from _products((np.column_stack([w, np.ones(len(w))]) for w in whole), k + 1)

    sums = _gathered(_rows(vectors, id_col, vector_col).select("v"), run, k + 1) / model.space.n
    return float(np.abs(sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k]) - np.eye(k)).max())


def report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable vector and leading component.

    Vectors that are null or empty, or hold a null, a non-finite entry or one beyond 2^55, are dropped; so are those of another
    length than most have (ties: the longer). Null and repeated ids stay as they are, repeated rows count as often as they stand.
    Components without variance (fewer vectors than dimensions, equal vectors) have no rows; equal eigenvalues are numbered in a
    fixed order. ``deviation`` is null where it exceeds a long. An empty table gives no rows. Other columns are ignored.
    """
    model = fit(vectors, id_col, vector_col, most)
    if model is None or not len(model.values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    off = identity_error(vectors, model, id_col, vector_col)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    long = whitened(vectors, model, id_col, vector_col).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return long.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.space.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("k")).alias("explained"), F.lit(off).alias("identity_error"),
    )
