"""Connected components by alternating star operations, as joins and grouped minima."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutlake.llm.common import discard, materialize


def spanning_edges(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a boolean matrix that keep its components connected, fewer than its rows and columns.

    rows and columns name the nodes (numbers from 0) of the matrix's sides; a node may be in both.
    """
    n = int(max(rows.max(), columns.max())) + 1
    label = np.arange(n)
    left = linked & (rows[:, None] != columns[None, :])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while (has := left.any(1)).any():
        at = np.flatnonzero(has)
        a, b = rows[at], columns[left[at].argmax(1)]
        # One link for each component that still has some: hook its label below another's.
        _, one = np.unique(label[a], return_index=True)
        a, b = a[one], b[one]
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            i, j = label[x], label[y]
            if i != j:
                label[label == max(i, j)] = min(i, j)
                found.append((x, y))
        left &= label[rows][:, None] != label[columns][None, :]
    return np.array([x for x, _ in found], np.int64), np.array([y for _, y in found], np.int64)


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b: long) → node, component: the least node that links reach; only nodes with links to others.

    A node of great degree is met by a grouped minimum, which combines before its shuffle, and by a
    join, whose oversized partitions adaptive execution splits. Each round's edges are written to the
    shared folder, so a lost executor costs one round at most, and the round before is removed. Rounds go on
    until nothing changes; their number grows with the logarithm of the nodes of the largest component.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
        before, now = now, materialize(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        discard(before)
        sign = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if sign == seen:
            stars = now.groupBy("a").agg(F.min("b").alias("b"))
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = sign
