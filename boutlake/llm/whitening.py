"""Whitening of embeddings by their principal components.

Entries become whole numbers x (``STEPS`` to one, from ``ORIGIN`` up). Each partition computes its count, its sums and
the centred scatter of its vectors, batch by batch; Chan's formula merges two such moments, in each task
and then pair by pair in treeReduce. Sums are exact, and distances between means are taken from them, so the
great common offset of the numbers is never squared. The driver sees one matrix of dimension by dimension and
takes its eigenvectors. A second pass computes the moments of the whitened vectors in the same way and states
how far their covariance is from the identity; a third gives the rows. Work is linear in the rows, and
memory grows with the square of the dimension alone.

Rows whose vector is null, empty or holds null or non-finite entries are dropped. All vectors are to
have one length: that of most rows (of equals the longest); rows of other lengths are dropped too. Entries whose
number is beyond 2 ** 52 count as that. Components whose eigenvalue is not above rounding (there are as many as
repeated rows and few rows leave without spread) have no whitened value and are left out, so that a
table of equal vectors has no components. deviation is null where it is more than a long holds. Repeated rows
each count; a null vec_id stays null, and ids may be of any type. Extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS, ORIGIN = 64, 1_000_000
COMPONENTS = 32
#: Numbers whose squares are summed in long arithmetic.
_LONG = float(1 << 63)
_FAR = float(1 << 52)
#: Rows whose moments are taken at a time.
ROWS = 4096


@dataclass(frozen=True)
class Moments:
    """Count, exact sums and centred scatter of some vectors."""

    n: int
    sums: np.ndarray  # of Python's integers, or of doubles where the vectors are not whole numbers
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of x, integers or doubles."""
        if x.dtype == np.int64:  # sums of halves, which do not overflow
            sums = (x >> 26).sum(0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(0).astype(object)
            # A whole number near the mean is taken off first, exactly, so that the rest keeps its digits.
            middle = np.array([int(s) // len(x) for s in sums], np.int64)
            centred = (x - middle).astype(np.float64)
            centred -= np.array([(int(s) - int(m) * len(x)) / len(x) for s, m in zip(sums, middle, strict=True)])
        else:
            sums, centred = x.sum(0), x - x.mean(0)
        return Moments(len(x), sums, centred.T @ centred)

    def merged(self, other: Moments) -> Moments:
        """Chan's pairwise formula."""
        if not self.n or not other.n:
            return other if other.n else self
        n = self.n + other.n
        far = np.array(other.sums * self.n - self.sums * other.n, np.float64) / (self.n * other.n)
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(far, far) * (self.n * other.n / n))


_NOTHING = Moments(0, np.zeros(0), np.zeros((0, 0)))


@dataclass(frozen=True)
class Whitening:
    """Count and sums of the vectors that were fitted, and their principal components by falling eigenvalue."""

    n: int
    sums: np.ndarray
    axes: np.ndarray  # a column for each component
    values: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: in longs where they fit."""
        far = max(int(np.abs(x).max(initial=0)) * self.n, *(abs(int(s)) for s in self.sums))
        if far < 1 << 61:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64) @ self.axes / np.sqrt(self.values)


def _entries(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of a list column that take part, and their numbers."""
    column = column.cast(pa.list_(pa.float64()))
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)  # null entries become NaN
    bad = np.append(0, np.cumsum(~np.isfinite(flat)))
    good = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(at) == length) & (length > 0) & (bad[at[1:]] == bad[at[:-1]])
    rows = np.flatnonzero(good)
    values = flat[at[rows][:, None] + np.arange(length)] if len(rows) else np.zeros((0, length))
    return rows, np.clip(np.floor(values * STEPS) + ORIGIN, -_FAR, _FAR).astype(np.int64)


def _moments(vectors: DataFrame, length: int, whitening: Whitening | None = None) -> Moments:
    """Moments of all rows, or of them whitened: one for each partition, merged in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _NOTHING
        for batch in batches:
            _, x = _entries(batch["embedding"], length)
            for i in range(0, len(x), ROWS):
                found = found.merged(Moments.of(x[i : i + ROWS] if whitening is None else whitening.whitened(x[i : i + ROWS])))
        sums = [str(s) if whitening is None else repr(float(s)) for s in found.sums]
        yield pa.RecordBatch.from_arrays([pa.array([found.n]), pa.array([sums], pa.list_(pa.string())), pa.array([found.scatter.tobytes()])], ["n", "sums", "scatter"])

    def read(row) -> Moments:
        sums = np.array([int(s) if whitening is None else float(s) for s in row.sums], object if whitening is None else np.float64)
        return Moments(row.n, sums, np.frombuffer(row.scatter).reshape(len(sums), len(sums)))

    parts = vectors.select("embedding").mapInArrow(run, "n long, sums array<string>, scatter binary")
    return parts.rdd.map(read).treeReduce(Moments.merged)


def usual_length(vectors: DataFrame) -> int:
    """The length that most vectors have; of equals the longest; 0 if there is none."""
    sizes = vectors.select(F.size("embedding").alias("size")).where("size > 0").groupBy("size").count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> tuple[int, Whitening | None]:
    """The vectors' length, and their whitening by at most so many components; None if no vector takes part."""
    length = usual_length(vectors)
    found = _moments(vectors, length) if length else _NOTHING
    if not found.n:
        return length, None
    values, axes = np.linalg.eigh(found.scatter / found.n)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(length)] < 0, -1.0, 1.0)
    most = int(np.sum(values > max(values[0], 0) * length * np.finfo(float).eps)) if values[0] > 0 else 0
    most = min(most, components)
    return length, Whitening(found.n, found.sums, axes[:, :most], values[:most], float(np.trace(found.scatter) / found.n))


def identity_error(vectors: DataFrame, length: int, whitening: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity."""
    found = _moments(vectors, length, whitening)
    return float(np.abs(found.scatter / found.n - np.eye(len(found.scatter))).max(initial=0.0))


def whiten(vectors: DataFrame, length: int, whitening: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (an entry for each component) of every row that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _entries(batch["embedding"], length)
            for i in range(0, len(rows), ROWS):
                far, y = whitening.deviations(x[i : i + ROWS]), whitening.whitened(x[i : i + ROWS])
                rough = (far.astype(np.float64) ** 2).sum(1)
                total = (far * far).sum(1) if rough.max() < 0.99 * _LONG else [int(s) if int(s) < 1 << 63 else None for s in (far.astype(object) ** 2).sum(1)]
                offsets = np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(y).ravel()))
                yield pa.RecordBatch.from_arrays([batch["vec_id"].take(pa.array(rows[i : i + ROWS])), pa.array([None if s is None else int(s) for s in total], pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def op12_embedding_whitening(embeddings: DataFrame) -> DataFrame:
    """One row for each vector and component."""
    length, whitening = fit_whitening(embeddings)
    if whitening is None:
        whitening, error = Whitening(0, np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0), 0.0
    else:
        error = identity_error(embeddings, length, whitening)
    share = F.array(*(F.lit(float(v / whitening.trace)) for v in whitening.values)) if len(whitening.values) else F.array().cast("array<double>")
    rows = whiten(embeddings, length, whitening).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(whitening.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
