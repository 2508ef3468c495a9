"""Total orders over whole tables without sorting them in one task: ranges of keys, neighbours, numbers, pages."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range; most ranges; keys of the sample for each range.
RANGE_ROWS = 100_000
MOST_RANGES = 4096
SAMPLED = 16


def cuts_of(df: DataFrame, order: Sequence[str], rows_each: int = RANGE_ROWS) -> list[tuple]:
    """Keys that cut df into ranges of about rows_each rows, in order: at most MOST_RANGES - 1 of its own keys.

    They are drawn by the keys' hashes, at most MOST_RANGES * SAMPLED of them by expectation, so every run cuts alike.
    """
    n = df.count()
    ranges = max(1, min(MOST_RANGES, ceil(n / rows_each)))
    if ranges == 1:
        return []
    share = min(1.0, SAMPLED * ranges / n)
    sample = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    keys = sample.orderBy(*order).collect()
    return [tuple(keys[i * len(keys) // ranges]) for i in range(1, ranges) if keys]


def range_of(df: DataFrame, order: Sequence[str], cuts: Sequence[tuple]) -> DataFrame:
    """df with __range: how many of the cuts are not above the row's key. A key is compared with about log2(len(cuts)) of them.

    The cuts are one value of the plan, a scalar subquery: rows of a join with them would each copy them all.
    """
    if not cuts:
        return df.withColumn("__range", F.lit(0))
    element = f"struct<{','.join(f'`{c}`:{df.schema[c].dataType.simpleString()}' for c in order)}>"
    table = df.sparkSession.createDataFrame([(list(cuts),)], f"__cuts array<{element}>").scalar()
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))))
    # The key is an element of an array, so that it is made once and not for each comparison; beyond the last cut there is null.
    below = lambda key: F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get("__cuts", n + step - 1) <= key, n + step).otherwise(n))
    return df.withColumn("__cuts", table).withColumn("__range", F.get(F.transform(F.array(F.struct(*order)), below), F.lit(0))).drop("__cuts")


def with_ranges(df: DataFrame, order: Sequence[str], rows_each: int = RANGE_ROWS) -> DataFrame:
    """df with __range, a number that rises with the order's keys; ranges hold about rows_each rows.

    All columns of the order make the key: a frequent first value is cut by the next one. Equal keys share a
    range. Nulls come first.
    """
    return range_of(df, order, cuts_of(df, order, rows_each))


def with_neighbours(df: DataFrame, order: Sequence[str], columns: dict[str, tuple[str, str]], rows_each: int = RANGE_ROWS) -> DataFrame:
    """df with columns of the rows before and after each in a total order: column -> its two new names.

    Neighbours are found within ranges; the first and last rows of ranges, one of each a range, are put in
    order by themselves and carried to the next range that has rows.
    """
    rows = with_ranges(df, order, rows_each).withColumns({"__key": F.struct(*order), "__row": F.struct(*columns)})
    inside, across = Window.partitionBy("__range").orderBy(*order), Window.orderBy("__range")
    ends = rows.groupBy("__range").agg(F.min_by("__row", "__key").alias("first"), F.max_by("__row", "__key").alias("last"))
    ends = ends.select("__range", F.lag("last").over(across).alias("__left"), F.lead("first").over(across).alias("__right"))
    rows = rows.withColumns({"__before": F.lag("__row").over(inside), "__after": F.lead("__row").over(inside)}).join(F.broadcast(ends), "__range")
    before, after = F.coalesce("__before", "__left"), F.coalesce("__after", "__right")
    named = {n: side[c] for c, names in columns.items() for n, side in zip(names, (before, after), strict=True)}
    return rows.withColumns(named).select(*df.columns, *named)


def with_ids(df: DataFrame, order: Sequence[str], after: int = 0, rows_each: int = RANGE_ROWS) -> DataFrame:
    """df with id, counted on from after in a total order.

    Rows are numbered within ranges, ranges by their counts, so no task sorts the table.
    """
    rows = with_ranges(df, order, rows_each)
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(F.broadcast(counts.select("__range", before.alias("__before"))), "__range")
    nth = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return rows.withColumn("id", after + F.col("__before") + nth).select(*df.columns, "id")
