"""Near-duplicates by SimHash fingerprints, compared exactly tile against tile.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Distinct
fingerprints are laid out in tiles by the bit counts of their four 16-bit quarters, large tiles split.
Fingerprints that differ in at most ``radius`` bits have quarter counts that differ by at most that in
all, so a tile meets only tiles within that distance; all other pairs are skipped unseen. A pair of
tiles is compared whole, with exclusive-or and bit counts in numpy, and yields links that span its
components rather than every link. No candidate is capped, and equal fingerprints are one node.

Names of tiles are paired first and dealt evenly over tasks; only then do fingerprints follow. Work grows with the
square of the distinct fingerprints: of random ones one pair in 25 is compared, so a million make 2.0e10
comparisons and a hundred million 2.0e14.

Null and empty texts have fingerprint zero and link like any other; very long texts are read whole. Rows
without doc_id take their group's component, which is null where no row of the group has an id. doc_id may
be of any type that has an order, and keeps it. Repeated rows each get a result. Extra columns are left out
of results by document and kept by drop_near_duplicates, whatever their names. No rows give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boutlake.llm.common import binary_texts, materialize, slices
from boutlake.llm.components import connected_components, spanning_edges

WORDS = 3
RADIUS = 3
SEED = 42
TILE = 1024
#: Pairs of tiles for a task, and most tasks; beyond so many pairs a task takes more.
PAIRS = 2_000
MOST_TASKS = 100_000


def fingerprints_of(texts: list[bytes], width: int = WORDS, seed: int = SEED) -> np.ndarray:
    """One fingerprint (int64) per text; ASCII letters are taken as lower case."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends[: max(0, len(words) - width)])]
        before = len(hashes)
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :] or ends[-1:], strict=True)]
        counts[k] = len(hashes) - before
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        h = np.array(hashes, np.uint64)
        begins = (np.cumsum(counts) - counts)[full]
        ones = np.empty((len(full), 64), np.int64)
        for bit in range(64):
            ones[:, bit] = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(1), begins).astype(np.int64)
        out[full] = ((2 * ones > counts[full][:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return out.view(np.int64)


def simhash(docs: DataFrame, width: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), fp (the fingerprint's 64 bits as a long) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_texts(batch["text"])
            fps = np.concatenate([fingerprints_of(texts[i:j], width, seed) for i, j in slices(texts)] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_key"], pa.array(fps)], ["doc_id", "text_key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def _quarters(fp: str) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each opposite pair, none first."""
    every = itertools.product(range(-radius, radius + 1), repeat=4)
    return sorted(x for x in every if sum(map(abs, x)) <= radius and x >= (0, 0, 0, 0))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """fps (fp: long, distinct) → a, b: links within radius that connect every component they form."""
    counts = [f"q{i}" for i in range(4)]
    rows = fps.select("fp", *(c.alias(n) for c, n in zip(_quarters("fp"), counts, strict=True)))
    # At most 17 ** 4 rows, whatever the corpus.
    parts = rows.groupBy(*counts).agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    tiles = (
        rows.join(F.broadcast(parts), counts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy(*counts, "part").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    tiles = materialize(tiles.withColumn("name", F.monotonically_increasing_id()), "tiles")
    steps = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(s, ("d0", "d1", "d2", "d3"), strict=True))) for s in _steps(radius)))
    # Names of tiles meet by quarter counts; the fingerprints follow once the pairs are dealt evenly.
    guests = tiles.select(F.col("name").alias("guest"), *counts, F.explode(steps).alias("d")).select(
        "guest", *((F.col(f"q{i}") + F.col(f"d.d{i}")).alias(f"q{i}") for i in range(4)), (F.array("d.d0", "d.d1", "d.d2", "d.d3") == F.array(*[F.lit(0)] * 4)).alias("own"))
    met = tiles.select("name", *counts).join(guests, counts).where(~F.col("own") | (F.col("guest") >= F.col("name"))).select("name", "guest")
    met = materialize(met, "tile-pairs")
    met = met.repartition(max(1, min(-(-met.count() // PAIRS), MOST_TASKS)), "name", "guest")
    pairs = met.join(tiles.select(F.col("name").alias("guest"), F.col("fps").alias("others")), "guest").join(tiles.select("name", "fps"), "name").select("fps", "others", (F.col("name") == F.col("guest")).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.uint8(radius)
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            left, right = batch["fps"], batch["others"]
            a_all, a_at = left.values.to_numpy().view(np.uint64), left.offsets.to_numpy()
            b_all, b_at = right.values.to_numpy().view(np.uint64), right.offsets.to_numpy()
            for i, same in enumerate(batch["same"].to_pylist()):
                a, b = a_all[a_at[i] : a_at[i + 1]], b_all[b_at[i] : b_at[i + 1]]
                near = np.bitwise_count(a[:, None] ^ b[None, :]) <= most
                if same:
                    np.fill_diagonal(near, False)
                if near.any():
                    x, y = spanning_edges(near, np.arange(len(a)), np.arange(len(b)) + (0 if same else len(a)))
                    both = a if same else np.concatenate([a, b])
                    found.append((both[x].view(np.int64), both[y].view(np.int64)))
            columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def _classes(docs: DataFrame, radius: int, width: int, seed: int, tile: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with fingerprints; component of each fingerprint; first row of each component, by doc_id and text_key."""
    rows = materialize(simhash(docs, width, seed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    groups = connected_components(fingerprint_links(nodes.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    rooted = nodes.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return rows, rooted.select("fp", "component"), rooted.groupBy("component").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WORDS, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """doc_id, fp, component_id (least doc_id that links reach) for each row of docs."""
    rows, rooted, firsts = _classes(docs, radius, width, seed, tile)
    by_fp = rooted.join(firsts, "component").select("fp", F.col("first.doc_id").alias("component_id"))
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WORDS, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """The first row of each group, by doc_id (null last) and the text's hash, with all columns of docs.

    Rows that repeat an id and text are reduced in each task before they meet; the one of the least hash stays.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    firsts = _classes(docs, radius, width, seed, tile)[2].select(name(F.col("first.doc_id")).alias("id"), F.col("first.text_key").alias("key"))
    # The caller's columns travel as one struct, so that none of them meets the names used here.
    rows = docs.select(name(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.join(firsts, ["id", "key"], "left_semi").groupBy("id", "key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return rows.select("row.*")


def op9_simhash_near_dedup(documents: DataFrame) -> DataFrame:
    """Fingerprint and component of every document; nulls, empty texts, repeats and ids as in the module."""
    return near_duplicates(documents).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
