"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: About this much text is held in Python at a time; one longer text is still taken whole.
SLICE_BYTES = 2 << 20
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Without that setting a local master gets a temporary folder; a cluster gets an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    own = getattr(spark, "_boutlake_dir", None)
    if own is None:
        own = spark._boutlake_dir = "file://" + tempfile.mkdtemp(prefix="boutlake-")
    return own


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back, so that no later step repeats its work."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/boutlake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder that materialize wrote df to; nothing may read it later."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if folder is not None and folder.getParent().getName() == "boutlake":
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def planned_parts(df: DataFrame, bytes_each: int) -> int:
    """Parts of about bytes_each by the planner's size estimate, at least spark.sql.shuffle.partitions."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-estimate // bytes_each), 1 << 20))


def binary_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about limit bytes in all."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones((2, 1), np.uint64)
#: A fixed random number for each byte.
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the base and of its inverse, modulo 2 ** 64."""
    global _POWERS
    if _POWERS.shape[1] < n:
        size = 1 << n.bit_length()
        steps = np.array([[_BASE], [_INVERSE]], np.uint64).repeat(size, 1)
        steps[:, 0] = 1
        _POWERS = np.cumprod(steps, 1, np.uint64)
    return _POWERS[:, :n]


def spans_hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes modulo 2 ** 64 of the runs values[start:end], wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


class Words:
    """The words of several texts: buffer of bytes, start and end of each word in it, number of its text."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts)
        self.buffer = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.cumsum(lengths + 1) - lengths - 1
        gap = np.ones(len(joined) + 2, bool)
        gap[1:-1] = _IS_GAP[self.buffer]
        turns = np.flatnonzero(gap[1:] != gap[:-1])
        self.starts, self.ends = turns[::2], turns[1::2]
        self.doc = np.searchsorted(self.begins, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mixed(spans_hashed(BYTE_VALUES[self.buffer], self.starts, ends))

    def bags(self, values: np.ndarray) -> np.ndarray:
        """The sum of values over each word's bytes."""
        sums = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum(values[self.buffer], out=sums[1:])
        return sums[self.ends] - sums[self.starts]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer over 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
