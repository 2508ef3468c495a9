"""Groups of keys that links connect, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boutlake.sources.shared import shared_path


def _kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, which cuts its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_groups(links: DataFrame) -> DataFrame:
    """links (a, b: one orderable type) → key, key_group: the least key that links reach, for every key of a link.

    Each round points every key at the least of its neighbours and then those at each other, so that long chains halve;
    it ends when a round changes nothing. Minima combine before their shuffle, so a key with very many links is no hot spot.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    now = _kept(ends.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links")
    seen = None
    while True:
        pairs = now.where("low <> high")
        near = pairs.select(F.col("low").alias("k"), F.col("high").alias("o")).unionByName(pairs.select(F.col("high").alias("k"), F.col("low").alias("o")))
        best = near.groupBy("k").agg(F.min("o").alias("m")).select("k", F.least("k", "m").alias("m"))
        # Every neighbour above a key goes to the key's least one ...
        up = near.where("o > k").join(best, "k").select(F.col("o").alias("k"), "m").where("k <> m").distinct()
        low = up.groupBy("k").agg(F.min("m").alias("least"))
        # ... and what a key then points at goes to the least of these.
        down = up.join(low, "k").select(F.explode(F.array(F.struct("k", F.col("least").alias("m")), F.struct(F.col("m").alias("k"), F.col("least").alias("m")))).alias("e"))
        now = _kept(down.select(F.least("e.k", "e.m").alias("low"), F.greatest("e.k", "e.m").alias("high")).where("low <> high").distinct(), "links")
        sign = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
        if sign == seen:
            break
        seen = sign
    stars = now.groupBy(F.col("high").alias("key")).agg(F.min("low").alias("key_group"))
    keys = ends.select(F.col("a").alias("key")).unionByName(ends.select(F.col("b").alias("key"))).distinct()
    return keys.join(stars, "key", "left").withColumn("key_group", F.coalesce("key_group", "key"))
