"""Elo ratings, K factors and the composite ranking."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal
from math import floor

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.operators.groups import connected_groups

# How much more a round counts; the first text that a round holds decides.
ROUND_FACTORS = (("final", 1.25), ("semi", 1.15), ("quarter", 1.10), ("consol", 1.05))
#: A first rating, in thousandths.
START = 1_500_000
STEP = Decimal("0.001")
#: Bouts of a pool beyond which its connected groups are folded apart.
SPLIT_ABOVE = 1_000_000
RATED = "bout_no long, id long, wrestler_id long, opponent_id long, k double, r_before double, o_before double, r_after double, o_after double"


def round_factor(round_: Column) -> Column:
    """ "Semifinal" holds "final" and counts as one."""
    low = F.lower(F.coalesce(round_, F.lit("")))
    out = F.when(low.contains(ROUND_FACTORS[0][0]), ROUND_FACTORS[0][1])
    for text, factor in ROUND_FACTORS[1:]:
        out = out.when(low.contains(text), factor)
    return out.otherwise(1.0)


def with_k(bouts: DataFrame, base: float = 24.0, late: float = 0.5, pool: Sequence[str] = ("season",)) -> DataFrame:
    """bouts (pool, start, id, round) with bout_no and k: more for late bouts and high rounds.

    Bouts are put in order within a day, and days by their counts of bouts, so no task sorts a whole pool.
    """
    keys = list(pool)
    df = bouts.withColumn("__day", F.to_date("start"))
    counts = df.groupBy(*keys, "__day").agg(F.count("*").alias("__n"))
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__day").alias("__d"), F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("__all"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col("__day").eqNullSafe(F.col("__d"))]
    df = df.join(counts, same)
    w = Window.partitionBy(*keys, "__day")
    rank = F.col("__before") + F.rank().over(w.orderBy("start"))
    share = F.when(F.col("__all") > 1, (rank - 1) / (F.col("__all") - 1)).otherwise(0.0)
    no = F.col("__before") + F.row_number().over(w.orderBy("start", "id"))
    df = df.withColumns({"bout_no": no.cast("long"), "k": F.round(base * (1 + late * share) * round_factor(F.col("round")), 3)})
    return df.select(*bouts.columns, "bout_no", "k")


def moved(points: int, change: float) -> int:
    """Thousandths after a change, as the decimals of its shortest text round: to the nearest, halves away from zero."""
    x = change * 1000
    whole = floor(x + 0.5)
    if abs(x - whole) < 0.499999:  # far from a half, so that the float's own error plays no part
        return points + whole
    return int(((Decimal(points) / 1000 + Decimal(repr(change))).quantize(STEP, ROUND_HALF_UP)) * 1000)


def rate(athlete: int, other: int, k: float, won: int, rating: dict[int, int]) -> tuple[float, float, float, float]:
    """Ratings of both before and after a bout; they are kept in whole thousandths after each."""
    a, o = rating.get(athlete, START), rating.get(other, START)
    change = k * (won - 1 / (1 + 10 ** ((o - a) / 1000 / 400)))
    rating[athlete], rating[other] = a2, o2 = moved(a, change), moved(o, -change)
    return a / 1000, o / 1000, a2 / 1000, o2 / 1000


def elo(bouts: DataFrame, pool: Sequence[str] = ("season",), split_above: int = SPLIT_ABOVE) -> DataFrame:
    """bouts (pool, bout_no, id, wrestler_id, opponent_id, won 0/1, k) → ratings around each bout.

    Each bout depends on those before it of either athlete. Pools of at most split_above bouts are folded by one task
    each; in larger ones each group of athletes whom bouts connect is, for groups do not touch one another. A task
    reads sorted batches: it holds one rating an athlete, never the bouts.
    """
    kinds = {f.name: f"{f.name} {f.dataType.simpleString()}" for f in bouts.schema.fields if f.name in pool}
    names = [*pool, *(x.split()[0] for x in RATED.split(", "))]
    rows = bouts.select(*pool, "bout_no", "id", "wrestler_id", "opponent_id", "won", "k")
    large = rows.groupBy(*pool).agg(F.count("*").alias("__n")).where(F.col("__n") > split_above)
    if large.limit(1).count():
        side = lambda c: F.struct(*pool, F.col(c).cast("long").alias("athlete"))
        links = rows.join(large, list(pool), "left_semi").select(side("wrestler_id").alias("a"), side("opponent_id").alias("b"))
        groups = connected_groups(links).select(F.col("key").alias("__key"), F.col("key_group.athlete").alias("__group"))
        rows = rows.join(groups, side("wrestler_id") == F.col("__key"), "left").drop("__key")
    else:
        rows = rows.withColumn("__group", F.lit(None).cast("long"))

    kept = [*pool, "bout_no", "id", "wrestler_id", "opponent_id", "k"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rating = None, {}
        for part in parts:
            keys = zip(*(part[p] for p in pool), part["__group"].fillna(-1).astype("int64"), strict=True)
            out = []
            for key, *bout in zip(keys, *(part[c].tolist() for c in ("wrestler_id", "opponent_id", "k", "won")), strict=True):
                if key != now:
                    now, rating = key, {}
                out.append(rate(*bout, rating))
            yield pd.concat([part[kept].reset_index(drop=True), pd.DataFrame(out, columns=names[len(kept) :], dtype="float64")], axis=1)

    ordered = rows.repartition(*pool, "__group").sortWithinPartitions(*pool, "__group", "bout_no")
    return ordered.mapInPandas(run, ", ".join([*(kinds[p] for p in pool), RATED]))


def elo_summary(rated: DataFrame, pool: Sequence[str] = ("season",)) -> DataFrame:
    """First and last rating, change, mean opponent, trend and bouts of each athlete, from both sides."""
    mine = rated.select(*pool, "bout_no", "wrestler_id", F.col("r_before").alias("before"), F.col("r_after").alias("after"), F.col("o_before").alias("other"))
    theirs = rated.select(*pool, "bout_no", F.col("opponent_id").alias("wrestler_id"), F.col("o_before").alias("before"), F.col("o_after").alias("after"), F.col("r_before").alias("other"))
    df = mine.unionByName(theirs).groupBy(*pool, "wrestler_id").agg(
        F.count("*").alias("bouts"), F.min_by("before", "bout_no").alias("first"), F.max_by("after", "bout_no").alias("last"),
        # Ratings have three places, so their sum in thousandths is exact whatever its order.
        F.round(F.sum(F.round(F.col("other") * 1000).cast("long")) / F.count("*") / 1000, 6).alias("schedule"), F.round(F.regr_slope("after", "bout_no"), 6).alias("slope"))
    return df.withColumn("delta", F.round(F.col("last") - F.col("first"), 3))


def composite(df: DataFrame, rating: str, delta: str, schedule: str, pool: Sequence[str]) -> DataFrame:
    """0.7 of the rating, 0.2 and 0.1 of how many population deviations delta and schedule are from their pool's mean.

    No deviation counts as 0. Means are taken once a pool and joined back.
    """
    stats = df.groupBy(*(F.col(p).alias(f"__{p}") for p in pool)).agg(*(f(c).alias(f"__{n}_{c}") for c in (delta, schedule) for n, f in (("avg", F.avg), ("sd", F.stddev_pop))))
    both = df.join(stats, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in pool])
    z = lambda c: F.when(F.col(f"__sd_{c}") > 0, (F.col(c) - F.col(f"__avg_{c}")) / F.col(f"__sd_{c}")).otherwise(0.0)
    return both.withColumn("score", F.round(0.7 * F.col(rating) + 0.2 * z(delta) + 0.1 * z(schedule), 6)).select(*df.columns, "score")
