"""Near-duplicate embeddings by an epsilon grid order join.

Equal vectors are one node with a count. Distinct vectors are projected on leading principal
dimensions; a grid there, whose cells are as wide as the greatest distance of a link, puts them in order of
cells, leading dimension first. The sequence is cut into consecutive tiles of a bounded number of bytes,
each a row that also holds the boxes of its intervals. Names of tiles whose cells touch are paired, and
pairs whose boxes all lie further apart than a link are skipped before any vector travels. A pair of tiles
is joined recursively: ranges of intervals whose boxes are distant are skipped, the others halved; short
ones are compared by an upper bound of the cosine from the projections, and what may reach ``least`` by the
cosine itself in double precision. No candidate is capped.

A pair of tiles yields a count of links for each vector and links that span its components, not every
link. Principal directions and the cuts of the sequence come from a bounded sample (about ``sample``
vectors, by hash); they steer which tiles are skipped and never the result. Where vectors fill the leading
dimensions evenly, no box is far from another and all tiles meet: work grows with the square of the number
of distinct vectors, and each travels once for every tile.

Null, zero and non-finite vectors, and vectors with null components, link with nothing; so do vectors of
different lengths. Repeated rows each count as a vector. Rows without vec_id link with nothing and have
a null component. vec_id may be of any type that has an order, and keeps it. Extra columns are left out,
whatever their names. No rows give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from boutlake.llm.common import materialize
from boutlake.llm.components import connected_components, spanning_edges

LEAST = 0.95
#: Leading dimensions whose cells pair tiles, that order the sequence, and that bound distances and cosines.
PAIRED = 3
ORDERED = 8
BOUND = 16
#: Vectors of an interval; bytes of the vectors of a tile; vectors of the sample.
SHORT = 512
TILE_BYTES = 4 << 20
SAMPLE = 3000
#: More than the rounding of a cosine's bound in single precision.
SLACK = 1e-4
#: Most partitions of pairs of tiles; beyond so many pairs a task takes several.
MOST_TASKS = 100_000
_TILE = pa.schema([("dim", pa.int32()), ("width", pa.int32()), ("cells", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("low", "high", "nodes", "copies", "raw"))])


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, raw (components in the column's own precision; null for vectors that cannot link), width (bytes of a component)."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch["vec_id"], batch["embedding"].cast(pa.list_(pa.float32() if single else pa.float64()))
            good = pa.compute.and_(ids.is_valid(), column.is_valid()).to_numpy(zero_copy_only=False)
            flat, at = column.values, column.offsets.to_numpy()
            values = np.nan_to_num(flat.to_numpy(zero_copy_only=False).astype(kind), nan=np.inf, posinf=np.inf, neginf=np.inf) + kind(0)
            raw = []
            for i, ok in enumerate(good):
                v = values[at[i] : at[i + 1]]
                raw.append(v.tobytes() if ok and len(v) and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(raw, pa.binary())], ["vec_id", "raw"])

    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {id_kind}, raw binary").withColumn("width", F.lit(np.dtype(kind).itemsize))


def units_of(raw: bytes, n: int, width: int) -> np.ndarray:
    """Rows of unit length; scaled first, so that neither large nor small components overflow."""
    x = np.frombuffer(raw, np.float32 if width == 4 else np.float64).reshape(n, -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Grid:
    """Cells of width reach over the leading principal dimensions of vectors of one length; others use their leading components."""

    def __init__(self, axes: np.ndarray, reach: float):
        self.axes, self.reach = axes, reach
        self.middle = int(np.ceil(1 / reach)) + 2
        self.base = 2 * self.middle + 1
        self.ordered = min(ORDERED, int(62 / np.log2(self.base)))

    def projected(self, units: np.ndarray) -> np.ndarray:
        return units @ self.axes if units.shape[1] == len(self.axes) else units[:, :BOUND]

    def key(self, p: np.ndarray, n: int) -> np.ndarray:
        """Cells of the first n dimensions as one number, in order of cells."""
        cells = np.zeros((len(p), n), np.int64)
        cells[:, : p.shape[1]] = np.floor(p[:, :n] / self.reach)
        return (cells + self.middle) @ (self.base ** np.arange(n - 1, -1, -1, dtype=np.int64))

    def steps(self) -> list[int]:
        """From the cell of the paired dimensions to itself and the cells that touch it."""
        return [int(np.dot(s, self.base ** np.arange(PAIRED - 1, -1, -1))) for s in itertools.product((-1, 0, 1), repeat=PAIRED)]


def boxes(p: np.ndarray, short: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of each interval of short rows."""
    starts = np.arange(0, len(p), short)
    return np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)


def interval_pairs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], reach: float, same: bool) -> Iterator[tuple[int, int]]:
    """Numbers of intervals whose boxes may hold a link, by halving ranges of them; of a sequence with itself, each pair once."""
    todo = [(0, len(a[0]), 0, len(b[0]))]
    while todo:
        i, j, k, m = todo.pop()
        if same and m <= i:
            continue
        gap = np.maximum(0, np.maximum(b[0][k:m].min(0) - a[1][i:j].max(0), a[0][i:j].min(0) - b[1][k:m].max(0)))
        if gap @ gap > reach * reach:
            continue
        if j - i == 1 == m - k:
            yield i, k
        elif j - i >= m - k:
            mid = (i + j) // 2
            todo += [(i, mid, k, m), (mid, j, k, m)]
        else:
            mid = (k + m) // 2
            todo += [(i, j, k, mid), (i, j, mid, m)]


class Side:
    """A tile as it is compared: nodes, copies, unit vectors, projections with what is left of their length, and boxes."""

    def __init__(self, row: dict, grid: Grid, short: int):
        self.nodes, self.copies = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64)
        self.units = units_of(row["raw"], len(self.nodes), row["width"])
        p = grid.projected(self.units)
        self.boxes = boxes(p, short)
        rest = np.sqrt(np.maximum(0.0, 1 - (p * p).sum(1)))
        self.sketch = np.column_stack([p, rest]).astype(np.float32)


def tile_links(a: Side, b: Side, least: float, reach: float, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links that span the components of two tiles (or of one with itself), as numbers over both; links of each row of a and of b."""
    same = a is b
    to_a, to_b = np.zeros(len(a.nodes), np.int64), np.zeros(len(b.nodes), np.int64)
    shift = 0 if same else len(a.nodes)
    label = np.arange(shift + len(b.nodes))
    xs: list[np.ndarray] = []
    ys: list[np.ndarray] = []
    for i, k in interval_pairs(a.boxes, b.boxes, reach, same):
        i, k = i * short, k * short
        # The cosine of two unit vectors is at most that of their projections plus the product of the rests.
        may = a.sketch[i : i + short] @ b.sketch[k : k + short].T >= np.float32(least - SLACK)
        if not may.any():
            continue
        r, c = i + np.flatnonzero(may.any(1)), k + np.flatnonzero(may.any(0))
        near = a.units[r] @ b.units[c].T >= least
        if same and i == k:
            near &= r[:, None] != c[None, :]
        if not near.any():
            continue
        to_a[r] += near @ b.copies[c]
        if not same:
            to_b[c] += near.T @ a.copies[r]
        elif i != k:
            to_a[c] += near.T @ a.copies[r]
        apart = near & (label[r][:, None] != label[shift + c][None, :])
        if apart.any():
            x, y = spanning_edges(apart, r, shift + c)
            for u, v in zip(label[x].tolist(), label[y].tolist(), strict=True):
                while label[u] != u:
                    u = int(label[u])
                while label[v] != v:
                    v = int(label[v])
                label[label == max(u, v)] = min(u, v)
            xs.append(x)
            ys.append(y)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys]), to_a, to_b


def embedding_links(nodes: DataFrame, least: float = LEAST, sample: int = SAMPLE, tile_bytes: int = TILE_BYTES, short: int = SHORT) -> DataFrame:
    """nodes (node: long, raw: binary, width: int, copies: long; raws distinct, cheap to reread) → a, b, n.

    Rows with b are links that span the components; rows without say that a links with n vectors of other nodes.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    size = nodes.agg(F.count("*").alias("n"), F.sum(F.length("raw")).alias("bytes")).first()
    # About `sample` vectors reach the driver, to fit directions for the commonest length among them and to cut the sequence.
    share = F.pmod(F.xxhash64("raw"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, size["n"]))) + 1
    drawn = [(bytes(r["raw"]), r["width"]) for r in nodes.where(share).select("raw", "width").collect()]
    lengths = [len(x) // w for x, w in drawn]
    dims = max(lengths, key=lengths.count, default=1)
    x = np.concatenate([np.zeros((1, dims)), *(units_of(r, 1, w) for r, w in drawn if len(r) // w == dims)])[bool(drawn) :]
    axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:BOUND].T
    grid = Grid(axes, reach)
    tiles = -(-(size["bytes"] or 1) // tile_bytes)
    cuts = np.unique(np.quantile(grid.key(grid.projected(x), grid.ordered), np.arange(1, tiles) / tiles, method="lower")) if tiles > 1 else np.zeros(0, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tile = np.zeros(batch.num_rows, np.int64)
            size = batch["dim"].to_numpy()
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                rows = batch.take(pa.array(at))
                p = grid.projected(units_of(b"".join(rows["raw"].to_pylist()), len(at), rows["width"][0].as_py()))
                tile[at] = np.searchsorted(cuts, grid.key(p, grid.ordered), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], [*batch.schema.names, "tile"])

    rows = nodes.select("node", "raw", "width", "copies", (F.length("raw") / F.col("width")).cast("int").alias("dim")).mapInArrow(place, "node long, raw binary, width int, copies long, dim int, tile long")
    # Cuts of a sample are uneven, and one cell may hold more than a tile: such tiles are split.
    parts = rows.groupBy("dim", "tile").agg(F.ceil(F.sum(F.length("raw")) / (2 * tile_bytes)).cast("int").alias("parts"))
    dealt = rows.join(parts, ["dim", "tile"]).withColumn("part", F.pmod(F.xxhash64("raw"), F.col("parts")).cast("int"))
    dealt = dealt.groupBy("dim", "tile", "part").agg(F.first("width").alias("width"), F.collect_list(F.struct("node", "raw", "copies")).alias("own"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                own, width = batch["own"][i].values, batch["width"][i].as_py()
                raws = own.field("raw").to_pylist()
                p = grid.projected(units_of(b"".join(raws), len(raws), width))
                # In order of cells, then of finer ones, so that an interval's box is small.
                order = np.lexsort([*np.floor(p / (reach / 4)).T[::-1], grid.key(p, grid.ordered)])
                low, high = boxes(p[order], short)
                out.append({
                    "dim": batch["dim"][i].as_py(), "width": width, "cells": np.unique(grid.key(p, PAIRED)).tolist(), "low": low.tobytes(), "high": high.tobytes(),
                    "nodes": own.field("node").to_numpy()[order].tobytes(), "copies": own.field("copies").to_numpy()[order].tobytes(), "raw": b"".join(raws[j] for j in order.tolist()),
                })
            yield from pa.Table.from_pylist(out, _TILE).to_batches() if out else []

    tiled = dealt.select("dim", "width", "own").mapInArrow(pack, "dim int, width int, cells array<long>, low binary, high binary, nodes binary, copies binary, raw binary")
    tiled = materialize(tiled.withColumn("name", F.monotonically_increasing_id()), "tiles")
    steps = F.array(*map(F.lit, grid.steps()))
    hosts = tiled.select("dim", "name", F.explode("cells").alias("cell"))
    guests = tiled.select("dim", F.col("name").alias("guest"), F.explode("cells").alias("at")).select("dim", "guest", F.explode(F.transform(steps, lambda s: F.col("at") + s)).alias("cell"))
    met = hosts.join(guests, ["dim", "cell"]).where("guest >= name").select("name", "guest").distinct()
    own_boxes = tiled.select("name", "low", "high", (F.length("nodes") / 8).cast("long").alias("n"))
    met = met.join(own_boxes, "name").join(own_boxes.select(F.col("name").alias("guest"), F.col("low").alias("low2"), F.col("high").alias("high2"), F.col("n").alias("n2")), "guest")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(x: bytes, n: int) -> np.ndarray:
            return np.frombuffer(x, np.float64).reshape(-(-n // short), -1)

        for batch in batches:
            keep = [
                next(interval_pairs((of(r["low"], r["n"]), of(r["high"], r["n"])), (of(r["low2"], r["n2"]), of(r["high2"], r["n2"])), reach, r["name"] == r["guest"]), None) is not None
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch["name"], batch["guest"]], ["name", "guest"]).filter(pa.array(keep, pa.bool_()))

    met = materialize(met.mapInArrow(prune, "name long, guest long"), "tile-pairs")
    # A number of partitions of its own: names weigh nothing, so they would else be gathered in one task.
    met = met.repartition(max(1, min(met.count(), MOST_TASKS)), "name", "guest")
    columns = ("width", "nodes", "copies", "raw")
    other = tiled.select(F.col("name").alias("guest"), F.struct(*columns).alias("other"))
    pairs = met.join(other, "guest").join(tiled.select("name", F.struct(*columns).alias("own")), "name")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a = Side(batch["own"][i].as_py(), grid, short)
                b = a if batch["name"][i] == batch["guest"][i] else Side(batch["other"][i].as_py(), grid, short)
                x, y, to_a, to_b = tile_links(a, b, least, reach, short)
                both = a.nodes if a is b else np.concatenate([a.nodes, b.nodes])
                many = to_a if a is b else np.concatenate([to_a, to_b])
                has = np.flatnonzero(many)
                first = np.concatenate([both[x], both[has]])
                second = pa.array(np.concatenate([both[y], np.zeros(len(has), np.int64)]), mask=np.arange(len(first)) >= len(x))
                yield pa.RecordBatch.from_arrays([pa.array(first), second, pa.array(np.concatenate([np.zeros(len(x), np.int64), many[has]]))], ["a", "b", "n"])

    return pairs.select("name", "guest", "own", "other").mapInArrow(compare, "a long, b long, n long")


def near_duplicate_vectors(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id for each row of vectors (vec_id, embedding)."""
    rows = materialize(_prepared(vectors).withColumn("key", F.sha2("raw", 256)), "vectors")
    nodes = rows.where("raw IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("raw").alias("raw"), F.first("width").alias("width"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = materialize(embedding_links(nodes.select("node", "raw", "width", "copies"), least), "links")
    sums = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    rooted = nodes.select("key", "node", "copies", "first").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = rooted.groupBy("component").agg(F.min("first").alias("least"))
    by_key = rooted.join(sums, "node", "left").join(firsts, "component").select("key", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), "least")
    return rows.select("vec_id", "key").join(by_key, "key", "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))


def op7_embedding_near_dedup(embeddings: DataFrame) -> DataFrame:
    """Links, components and representatives of all vectors; nulls, zeros, repeats and ids as in the module."""
    return near_duplicate_vectors(embeddings).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON id = vec_id LEFT JOIN n ON n.a = vec_id
"""
