"""Rollups, coverage, overlaps and head-to-head reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i


def rollup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each group and subtotal; level counts the keys summed over, so null keys are not totals."""
    return df.rollup(*keys).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def conditional_counts(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], distinct: str) -> DataFrame:
    """Distinct values of a column for each listed value of another, side by side."""
    return df.groupBy(*keys).agg(*(F.countDistinct(F.when(F.col(column) == v, F.col(distinct))).alias(f"n_{i}") for i, v in enumerate(values)))


def presence(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    return df.groupBy(key).agg(*(F.max(b2i(c)).alias(n) for n, c in flags.items()))


def overlap(flags: DataFrame, a: str, b: str) -> DataFrame:
    """Keys in both, in one only, and in either."""
    x, y = F.col(a) == 1, F.col(b) == 1
    n = lambda c, name: F.count_if(c).alias(name)
    return flags.agg(n(x & ~y, "first_only"), n(~x & y, "second_only"), n(x & y, "both"), n(x | y, "either"))


def coverage(reference: DataFrame, found: DataFrame, key: str, group: str) -> DataFrame:
    """Reference keys by group, how many are found, missing, and the share in percent."""
    hit = found.select(key).distinct().withColumn("__hit", F.lit(1))
    df = reference.select(group, key).distinct().join(hit, key, "left").groupBy(group)
    df = df.agg(F.count("*").alias("n_reference"), F.count("__hit").alias("n_matched"))
    return df.withColumns({"n_missing": F.col("n_reference") - F.col("n_matched"), "pct": F.round(100 * F.col("n_matched") / F.nullif("n_reference", F.lit(0)), 2)})


def census(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and rows of each table, columns matched by name."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()))


def head_to_head(pairs: DataFrame, bouts: DataFrame, except_: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """pairs (keys, first_place_id, second_place_id) with their meetings in bouts (keys, wrestler_id, opponent_id, outcome).

    Rows of either side count, but for those that except_ holds for; pairs that never met stay, with 0. Both
    sides' rows meet a pair by equality, once its ids and theirs are in order.
    """
    a, b = F.least("wrestler_id", "opponent_id"), F.greatest("wrestler_id", "opponent_id")
    met = bouts if except_ is None else bouts.where(~F.coalesce(except_, F.lit(False)))
    met = met.groupBy(*keys, a.alias("a"), b.alias("b")).agg(
        F.count("*").alias("n"), *(F.count_if((F.col("wrestler_id") == x) & (F.col("outcome") == "W")).alias(f"{n}_wins") for n, x in (("a", a), ("b", b))))
    one, two = F.col("first_place_id"), F.col("second_place_id")
    both = pairs.withColumns({"a": F.least(one, two), "b": F.greatest(one, two)}).join(met, [*keys, "a", "b"], "left")
    wins = lambda x: F.coalesce(F.when(x == F.col("a"), F.col("a_wins")).otherwise(F.col("b_wins")), F.lit(0))
    both = both.withColumns({"prior_meet_count": F.coalesce("n", F.lit(0)), "first_place_prior_wins": wins(one), "second_place_prior_wins": wins(two)})
    first, second = F.col("first_place_prior_wins"), F.col("second_place_prior_wins")
    series = F.when(F.col("prior_meet_count") == 0, "no_prior_meeting").when(first > second, "first_place_led_series").when(second > first, "second_place_led_series").otherwise("series_tied")
    return both.withColumn("prior_series_summary", series).select(*pairs.columns, "prior_meet_count", "first_place_prior_wins", "second_place_prior_wins", "prior_series_summary")


def finalist_report(bouts: DataFrame, keys: Sequence[str] = ("season", "weight_category")) -> DataFrame:
    """First and second of each bracket by the last State bout of each athlete, and their meetings but for State finals.

    bouts: keys with season first, wrestler_id, opponent_id, match_order, event, round, weight_category, outcome.
    """
    state = F.col("event").contains("State Championships")
    last = F.struct("match_order", "id")
    ends = bouts.where(state & F.col("weight_category").contains("A")).groupBy(keys[0], "wrestler_id").agg(F.max_by(F.struct(*keys[1:], "round", "outcome"), last).alias("e"))
    ends = ends.where(F.col("e.round").contains("1st Place Match")).select(keys[0], "wrestler_id", *(f"e.{k}" for k in keys[1:]), "e.outcome")
    one = ends.where("outcome = 'W'").select(*keys, F.col("wrestler_id").alias("first_place_id"))
    two = ends.where("outcome = 'L'").select(*keys, F.col("wrestler_id").alias("second_place_id"))
    return head_to_head(one.join(two, list(keys)), bouts, state & F.col("round").contains("1st Place Match"), keys[:1])


def finalist_pairs(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """placed (keys, wrestler_id, place) → first and second of each bracket."""
    one = placed.where(F.col("place").startswith("1st")).select(*keys, F.col("wrestler_id").alias("winner_id"))
    two = placed.where(F.col("place").startswith("2nd")).select(*keys, F.col("wrestler_id").alias("runner_up_id"))
    return one.join(two, list(keys))


def table_signature(df: DataFrame, updated: str | None = None) -> DataFrame:
    """Rows, the latest update and a sum of row hashes, equal for equal bags of rows in any order."""
    latest = F.max(updated) if updated else F.lit(None)
    return df.agg(F.count("*").alias("n_rows"), latest.cast("string").alias("last_updated"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))
