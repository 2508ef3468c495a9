"""A table kept in parts, each in a folder of its own, so that a change rewrites the parts that it touches and no others.

Rows are placed by a hash of their keys (buckets, for merges) or by ranges of their keys (for pages and copies). A
manifest names the folder of each part with its rows and a checksum. A change writes new folders for its parts and
then a new manifest, whose name is the next number: readers see the old table or the new one, a writer that loses
the race for a number fails, and a job that dies leaves the old table. Folders that no recent manifest names
are removed by ``vacuum``. All paths go through Hadoop's file systems, so a store may be wherever Spark reads and writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from boutlake.operators.ordered import cuts_of, range_of
from boutlake.operators.upsert import upsert

#: Rows of a part that the caller does not size, and parts that a sync writes before it commits them.
PART_ROWS = 1_000_000
BATCH = 256


@dataclass(frozen=True)
class Part:
    """Where a part's files are, its rows and the sum of their hashes."""

    folder: str
    rows: int
    checksum: str


@dataclass(frozen=True)
class State:
    """What a manifest holds. buckets is 0 for ranges; cuts are keys as JSON; done: marks of batches that are in the table."""

    version: int
    schema: str
    keys: list[str]
    buckets: int
    cuts: list[str]
    parts: dict[int, Part]
    done: dict[str, int]


def _with_checksums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """__part, rows, checksum of rows that know their part; equal for equal bags of rows in any order."""
    return df.groupBy("__part").agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string").alias("checksum"))


class Store:
    """A handle on the table at path; every call looks up the latest manifest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], buckets: int = 0, part_rows: int = PART_ROWS) -> Store:
        """Writes df as a new store: in so many buckets by a hash of keys, or without a number in ranges of keys of about part_rows rows."""
        store = cls(df.sparkSession, path)
        cuts = [] if buckets else _as_json(df, keys, part_rows)
        state = State(0, df.schema.json(), list(keys), buckets, cuts, {}, {})
        store._commit(replace(state, parts=store._written(store._placed(df, state), state)))
        return store

    # Manifests.

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _versions(self) -> list[int]:
        fs, path = self._fs()
        folder = path(f"{self.path}/manifests")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()) if fs.exists(folder) else []

    def state(self, version: int | None = None) -> State:
        if version is None:
            version = max(self._versions())
        fs, path = self._fs()
        stream = fs.open(path(f"{self.path}/manifests/{version}"))
        try:
            found = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return State(**found | {"parts": {int(k): Part(**v) for k, v in found["parts"].items()}})

    def _commit(self, state: State) -> None:
        """Writes the manifest under a name of its own and renames it; a number that is there already is an error."""
        fs, path = self._fs()
        made, final = path(f"{self.path}/manifests/_{uuid.uuid4().hex}"), path(f"{self.path}/manifests/{state.version}")
        stream = fs.create(made, False)
        stream.write(bytearray(json.dumps(state.__dict__ | {"parts": {k: v.__dict__ for k, v in state.parts.items()}}).encode()))
        stream.close()
        if fs.exists(final) or not fs.rename(made, final):
            fs.delete(made, False)
            raise RuntimeError(f"another writer has committed version {state.version} of {self.path}")

    # Rows.

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.state().schema))

    def _placed(self, df: DataFrame, state: State) -> DataFrame:
        """df with __part."""
        if state.buckets:
            return df.withColumn("__part", F.pmod(F.xxhash64(*state.keys), F.lit(state.buckets)).cast("int"))
        kind = StructType([df.schema[k] for k in state.keys])
        cuts = self.spark.createDataFrame([(c,) for c in state.cuts], "c string").select(F.from_json("c", kind).alias("c")).select("c.*").collect() if state.cuts else []
        return range_of(df, state.keys, [tuple(c) for c in cuts]).withColumn("__part", F.col("__range").cast("int")).drop("__range")

    def _read(self, state: State, parts: Iterable[int]) -> DataFrame:
        folders = [state.parts[p].folder for p in sorted(parts) if p in state.parts]
        schema = StructType.fromJson(json.loads(state.schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        state = self.state(version)
        return self._read(state, state.parts)

    def _written(self, rows: DataFrame, state: State) -> dict[int, Part]:
        """Rows with __part in new folders, sorted by the keys within ranges; the parts that came of them."""
        top = f"{self.path}/data/{uuid.uuid4().hex}"
        columns = [c for c in rows.columns if c != "__part"]
        dealt = rows.repartition(F.col("__part")) if state.buckets else rows.repartition(F.col("__part")).sortWithinPartitions("__part", *state.keys)
        dealt.write.partitionBy("__part").parquet(top)
        written = self.spark.read.schema(rows.select(*columns, F.col("__part")).schema).option("basePath", top).parquet(top)
        return {r["__part"]: Part(f"{top}/__part={r['__part']}", r["rows"], r["checksum"]) for r in _with_checksums(written, columns).collect()}

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows whose keys are among keys, read from the parts that may hold them; keys is small enough to name its parts."""
        state = self.state()
        parts = {r[0] for r in self._placed(keys.select(*state.keys), state).select("__part").distinct().collect()}
        return self._read(state, parts).join(keys.select(*state.keys), state.keys, "left_semi")

    # Changes.

    def merge(self, batch: DataFrame, tracked: Sequence[str], now, keep_good: Sequence[str] = (), mark: tuple[str, int] | None = None) -> set[int]:
        """Upserts batch by the store's keys as operators.upsert does, and rewrites the parts that it falls into; the parts' numbers.

        mark: a stream's name and the number of its batch; one that is in the table already changes nothing. Of a
        table of buckets only; parts whose rows all stay as they are keep their folders too.
        """
        state = self.state()
        if mark is not None and state.done.get(mark[0], -1) >= mark[1]:
            return set()
        placed = self._placed(batch, state)
        hit = {r[0] for r in placed.select("__part").distinct().collect()}  # at most one row a bucket
        merged = upsert(self._read(state, hit), batch, state.keys, tracked, now, keep_good)
        merged = self._placed(merged, state)
        changed = merged.groupBy("__part").agg(F.max(F.col("action").isin("inserted", "updated")).alias("c")).where("c")
        hit = {r[0] for r in changed.select("__part").collect()}
        done = state.done | ({mark[0]: mark[1]} if mark is not None else {})
        schema = StructType.fromJson(json.loads(state.schema))
        rows = merged.where(F.col("__part").isin(sorted(hit))).select(*(F.col(c).cast(schema[c].dataType) for c in schema.names), "__part")
        new = self._written(rows, state) if hit else {}
        self._commit(replace(state, version=state.version + 1, parts=state.parts | new, done=done))
        return hit

    def sync(self, source: DataFrame, batch: int = BATCH) -> list[int]:
        """Makes the store equal to source, copying only the parts whose checksums differ; the parts copied, in order.

        Both sides' checksums are by the store's own parts, so its files are not read. Every batch of parts is
        committed on its own: a copy that dies goes on with those that still differ.
        """
        state = self.state()
        schema = StructType.fromJson(json.loads(state.schema))
        if [(f.name, f.dataType) for f in source.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError("the source has other columns than the store")
        placed = self._placed(source, state)
        there = {r["__part"]: (r["rows"], r["checksum"]) for r in _with_checksums(placed, schema.names).collect()}
        differ = sorted(p for p in {*there, *state.parts} if p not in there or p not in state.parts or there[p] != (state.parts[p].rows, state.parts[p].checksum))
        for i in range(0, len(differ), batch):
            some = differ[i : i + batch]
            # The bounds of the parts reach the source's scan where they are ranges.
            rows = self._placed(self._bounded(source, state, some), state).where(F.col("__part").isin(some))
            new = self._written(rows, state) if any(p in there for p in some) else {}
            parts = {k: v for k, v in state.parts.items() if k not in some} | new
            state = replace(state, version=state.version + 1, parts=parts)
            self._commit(state)
        return differ

    def _bounded(self, df: DataFrame, state: State, parts: Sequence[int]) -> DataFrame:
        """df between the first key's bounds of these consecutive ranges; all of it for buckets."""
        if state.buckets or not parts:
            return df
        key, kind = state.keys[0], df.schema[state.keys[0]].dataType.simpleString()
        low = state.cuts[parts[0] - 1] if parts[0] > 0 else None
        high = state.cuts[parts[-1]] if parts[-1] < len(state.cuts) else None
        for text, below in ((low, False), (high, True)):
            value = json.loads(text).get(key) if text is not None else None
            if value is not None:  # nulls come first and have no upper neighbour to bound them
                bound = F.lit(value).cast(kind)
                df = df.where((F.col(key) <= bound) | F.col(key).isNull() if below else F.col(key) >= bound)
        return df

    # Pages.

    def page(self, start: int, size: int) -> DataFrame:
        """Rows start to start + size in the order of the keys, read from the ranges that hold them, and no others."""
        state = self.state()
        if state.buckets:
            raise ValueError("a store of buckets has no order")
        before, parts, skip = 0, [], 0
        for p in sorted(state.parts):
            n = state.parts[p].rows
            if before + n > start and before < start + size:
                skip = skip if parts else start - before
                parts.append(p)
            before += n
        return self._read(state, parts).orderBy(*state.keys).offset(skip).limit(size)

    def vacuum(self, keep: int = 2) -> int:
        """Removes the folders that none of the last keep manifests names, and older manifests; how many folders went."""
        fs, path = self._fs()
        versions = self._versions()
        used = {p.folder.rpartition("/")[0] for v in versions[-keep:] for p in self.state(v).parts.values()}
        named = {p.folder for v in versions[-keep:] for p in self.state(v).parts.values()}
        gone = 0
        for top in fs.listStatus(path(f"{self.path}/data")):
            name = f"{self.path}/data/{top.getPath().getName()}"
            folders = [name] if name not in used else [x for s in fs.listStatus(top.getPath()) if s.isDirectory() and (x := f"{name}/{s.getPath().getName()}") not in named]
            for folder in folders:
                fs.delete(path(folder), True)
                gone += 1
        for v in versions[:-keep]:
            fs.delete(path(f"{self.path}/manifests/{v}"), False)
        return gone


def _as_json(df: DataFrame, keys: Sequence[str], rows_each: int) -> list[str]:
    cuts = cuts_of(df, keys, rows_each)
    if not cuts:
        return []
    kind = StructType([df.schema[k] for k in keys])
    made = df.sparkSession.createDataFrame([(i, *c) for i, c in enumerate(cuts)], StructType([StructField("__i", IntegerType()), *kind]))
    return [r[0] for r in made.orderBy("__i").select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})).collect()]
