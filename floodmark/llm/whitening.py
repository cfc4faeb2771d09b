"""Embedding whitening: leading principal components by spectrum slicing.

Sums, covariances and the final check are partial sums of each task that Spark adds up; what
reaches the driver is one matrix of (dimensions squared) numbers. There the leading
eigenvalues are found one by one: the number of negative pivots of an LDL' factorisation of
the covariance minus a shift counts the eigenvalues below the shift (Sylvester's law of
inertia), so bisection isolates the k-th largest between two shifts. Rayleigh quotient
iteration inside that interval converges cubically to its vector, and two more counts close
to the quotient certify that it is number k. Eigenvalues that no shift can tell apart are
numbered together; their vectors are made orthogonal to each other.

A component c becomes the integer floor(scale * c) + shift. Rows are centred by their exact
deviation n * x - S (S: sums over all rows) before anything is multiplied.

Defined results: vectors that are null, empty or hold null or non-finite components take no
part; vectors of each length have their own means and components; repeated rows and rows with
null ids are rows like others; an empty table gives no rows. Components of magnitude above
2**40 / scale are cut there. A deviation beyond 64 bits is null. A component without
variance (one row, or fewer independent rows than components) has a null ``whitened``, and
``explained`` is null where there is no variance at all; the identity error is that of the
components with variance, null where there is none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.base import query, table
from floodmark.llm.topk import valid

COMPONENTS = 8
#: Magnitude of an integer component, at most.
LARGEST = 1 << 40
#: Growth bound of Bunch and Kaufman's pivot choice.
_ALPHA = (1 + math.sqrt(17)) / 8
_EPS = np.finfo(np.float64).eps


# -- spectrum slicing --------------------------------------------------------------


def below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix below ``shift``: negative pivots of LDL' with 1x1 and 2x2 pivots."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, negative = len(a), 0, 0
    while k < n:
        if k == n - 1:
            return negative + int(a[k, k] < 0)
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(np.argmax(column))
        own, most = abs(a[k, k]), float(column.max())
        if most == 0 or own >= _ALPHA * most:
            size, swap = 1, k
        else:
            others = np.abs(a[k:, r])
            others[r - k] = 0
            widest = float(others.max())
            if own * widest >= _ALPHA * most * most:
                size, swap = 1, k
            elif abs(a[r, r]) >= _ALPHA * widest:
                size, swap = 1, r
            else:
                size, swap = 2, r
        at = k + size - 1
        if swap not in (k, at):
            a[[at, swap], k:] = a[[swap, at], k:]
            a[k:, [at, swap]] = a[k:, [swap, at]]
        rest = a[k + size :, k : k + size].copy()
        if size == 1:
            negative += int(a[k, k] < 0)
            if a[k, k] != 0:
                a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0] / a[k, k], rest[:, 0])
        else:
            pivot = a[k : k + 2, k : k + 2]
            (p, q), (_, s) = pivot
            det = p * s - q * q
            negative += 1 if det < 0 else 2 * int(p + s < 0)
            a[k + 2 :, k + 2 :] -= rest @ (np.array([[s, -q], [-q, p]]) / det) @ rest.T
        k += size
    return negative


@dataclass
class Slices:
    """Numbers of eigenvalues from a shift on, each counted once."""

    matrix: np.ndarray
    known: dict[float, int]

    def __call__(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = len(self.matrix) - below(self.matrix, shift)
        return self.known[shift]

    def interval(self, number: int, width: float) -> tuple[float, float]:
        """(low, high) with eigenvalue ``number`` alone, or at most ``width`` apart."""
        low = max(s for s, n in self.known.items() if n >= number)
        high = min(s for s, n in self.known.items() if n < number)
        while not (self(low) == number and self(high) == number - 1) and high - low > width:
            low, high = self.halved(number, low, high)
        return low, high

    def halved(self, number: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self(middle) >= number else (low, middle)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray, scale: float) -> np.ndarray:
    """One inverse iteration; a shift that is an eigenvalue moves by a rounding error."""
    for step in range(8):
        try:
            out = np.linalg.solve(matrix - (shift + step * _EPS * scale) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        norm = np.linalg.norm(out)
        if np.isfinite(norm) and norm > 0:
            return out / norm
    return vector


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns."""
    n = len(matrix)
    count = min(count, n)
    scale = float(np.abs(matrix).sum(axis=1).max())
    if scale == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    # Gershgorin: no eigenvalue lies outside of +-scale.
    slices = Slices(matrix, {-2 * scale: n, 2 * scale: 0})
    least = 4 * n * _EPS * scale
    rng = np.random.default_rng(13)
    values, vectors = np.zeros(count), np.zeros((n, count))
    for k in range(count):
        before = vectors[:, :k]
        low, high = slices.interval(k + 1, least)
        while True:
            vector = rng.normal(size=n)
            shift = (low + high) / 2
            for turn in range(40):
                vector -= before @ (before.T @ vector)
                vector = _solved(matrix, shift, vector / np.linalg.norm(vector), scale)
                vector -= before @ (before.T @ vector)
                vector /= np.linalg.norm(vector)
                quotient = float(vector @ matrix @ vector)
                error = float(np.linalg.norm(matrix @ vector - quotient * vector))
                if error <= least:
                    break
                # Two steps at the middle turn the vector towards this interval's eigenvalue.
                if turn >= 1 and low < quotient < high:
                    shift = quotient
            # The counts certify the number: k values above, and number k + 1 not below.
            slack = error + least
            certified = slices(quotient + slack) <= k and slices(quotient - slack) >= k + 1
            if certified or high - low <= least:
                break
            low, high = slices.halved(k + 1, low, high)
        values[k], vectors[:, k] = quotient, vector
    order = np.argsort(-values, kind="stable")  # equal ones may come in any order
    return values[order], vectors[:, order]


# -- sums over all rows ------------------------------------------------------------


def integers(column: pa.ListArray, scale: int, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, their integer vectors) of the lists of a batch."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    data = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    sizes = np.diff(offsets)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        x = np.floor(data[offsets[rows][:, None] + np.arange(dim)] * scale)
        yield dim, rows, np.clip(x, -LARGEST, LARGEST).astype(np.int64) + shift


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: as 64-bit integers where all fit, else as Python's."""
    most = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if most < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def exact_squares(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; null beyond 64 bits."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in d.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def totals(rows: DataFrame, scale: int, shift: int) -> dict[int, tuple[int, list[int]]]:
    """For each dimension the number of vectors and the exact sums."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in integers(batch.column("v"), scale, shift):
                mine = held.setdefault(dim, [0, 0])
                mine[0] += len(x)
                mine[1] = mine[1] + x.sum(axis=0)
        at = [(dim, i, n, int(s)) for dim, (n, sums) in held.items() for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_pylist([dict(zip(("dim", "pos", "n", "s"), r, strict=True)) for r in at], _SUMS)

    found = rows.select("v").mapInArrow(partial, "dim int, pos int, n long, s long")
    found = found.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(found.collect()):
        out.setdefault(r.dim, (r.n, []))[1].append(int(r.s))
    return out


_SUMS = pa.schema([("dim", pa.int32()), ("pos", pa.int32()), ("n", pa.int64()), ("s", pa.int64())])
_PRODUCTS = pa.schema([("dim", pa.int32()), ("row", pa.int32()), ("sums", pa.list_(pa.float64()))])


def covariances(rows: DataFrame, centred: Callable, counts: dict[int, int], scale: int, shift: int) -> dict[int, np.ndarray]:
    """Covariance, divisor n, of centred(dim, x) for each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in integers(batch.column("v"), scale, shift):
                c = centred(dim, x)
                one = np.vstack([c.T @ c, c.sum(axis=0)])
                held[dim] = held[dim] + one if dim in held else one
        at = [{"dim": dim, "row": i, "sums": line.tolist()} for dim, m in held.items() for i, line in enumerate(m)]
        yield pa.RecordBatch.from_pylist(at, _PRODUCTS)

    parts = rows.select("v").mapInArrow(partial, "dim int, row int, sums array<double>")
    parts = parts.select("dim", "row", F.posexplode("sums").alias("column", "s")).groupBy("dim", "row", "column").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():
        wide = out.setdefault(r.dim, {})
        wide[r.row, r.column] = r.s
    for dim, cells in out.items():
        width = 1 + max(c for _, c in cells)
        m = np.zeros((width + 1, width))
        for at, s in cells.items():
            m[at] = s
        n = counts[dim]
        mean = m[-1] / n
        v = m[:-1] / n - np.outer(mean, mean)  # what centring left is a rounding error
        out[dim] = (v + v.T) / 2
    return out


@dataclass(frozen=True)
class Fit:
    """Means and leading components of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def live(self) -> np.ndarray:
        """Components with variance."""
        return self.values > len(self.sums) * 64 * _EPS * max(self.trace, 0.0)

    def centred(self, d: np.ndarray) -> np.ndarray:
        return (d / self.n).astype(np.float64)

    def whitened(self, d: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            w = (self.centred(d) @ self.vectors) / np.sqrt(self.values)
        w[:, ~self.live] = np.nan
        return w


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = 1024, shift: int = 100_000) -> dict[int, Fit]:
    """Means and components of all valid vectors, by vector length."""
    rows = _rows(vectors, vector_col)
    sums = totals(rows, scale, shift)
    center = lambda dim, x: (deviations(x, *sums[dim]) / sums[dim][0]).astype(np.float64)
    found = covariances(rows, center, {dim: n for dim, (n, _) in sums.items()}, scale, shift)
    return {dim: Fit(*sums[dim], *leading(v, components), float(np.trace(v))) for dim, v in found.items()}


def _rows(vectors: DataFrame, vector_col: str, *more) -> DataFrame:
    return vectors.where(valid(vector_col)).select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"), *more)


_OUT = "deviation long, dim int, whitened array<double>"


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = 1024, shift: int = 100_000
) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error for each valid vector and component."""
    spark = vectors.sparkSession
    models = fit(vectors, vector_col, components, scale, shift)
    rows = _rows(vectors, vector_col, F.col(f"`{id_col}`").alias("id"))

    def live(dim: int, x: np.ndarray) -> np.ndarray:
        own = models[dim]
        return own.whitened(deviations(x, own.n, own.sums))[:, own.live]

    errors = covariances(rows, live, {dim: m.n for dim, m in models.items()}, scale, shift) if models else {}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in integers(batch.column("v"), scale, shift):
                own = models[dim]
                d = deviations(x, own.n, own.sums)
                w = own.whitened(d)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel(), pa.float64(), from_pandas=True)
                )
                # Ids stay Arrow values, so that none is rounded beside a null.
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), pa.array(exact_squares(d), pa.int64()), pa.array(np.full(len(at), dim), pa.int32()), lists],
                    ["id", "deviation", "dim", "whitened"],
                )

    kind = vectors.schema[id_col].dataType.simpleString()
    projected = rows.mapInArrow(project, f"id {kind}, {_OUT}")
    told = []  # a few rows for each vector length
    for dim, m in models.items():
        error = errors.get(dim)
        error = float(np.abs(error - np.eye(len(error))).max()) if error is not None and len(error) else None
        for k, e in enumerate(m.values.tolist()):
            told.append((dim, k, m.n, e / m.trace if m.trace > 0 else None, error))
    known = spark.createDataFrame(told, "dim int, pos int, n long, explained double, identity_error double")
    cells = projected.select("id", "deviation", "dim", F.posexplode("whitened").alias("pos", "whitened"))
    return cells.join(known, ["dim", "pos"]).select(
        F.col("id").alias(id_col),
        (F.col("pos") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        "explained",
        "identity_error",
    )


@query()
def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings"), components=8, scale=1024, shift=100_000)
