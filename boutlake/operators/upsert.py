"""Write protocols as joins: each returns the whole new table, for one overwrite.

Keys match null-safely. A source with several rows for a key is reduced to one first, the least by
``order``; targets have one row a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i, not_blank


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def _on(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], now: Column, keep_good: Sequence[str] = (), order: Sequence[str] | None = None) -> DataFrame:
    """target merged with source, and action: inserted, updated, unchanged or kept (not in source).

    created_at stays; updated_at moves to now only if a tracked column differs null-safely. Columns in
    keep_good are not overwritten by null or blank. Running it again changes nothing.
    """
    source = first_per_key(source.select(*keys, *tracked), keys, order or tracked)
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    both = t.join(s, _on("t", "s", keys), "full_outer")
    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    new = {c: F.when(not_blank(F.col(f"s.{c}")), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in keep_good else F.col(f"s.{c}") for c in tracked}
    differs = reduce(lambda a, b: a | b, (~new[c].eqNullSafe(F.col(f"t.{c}")) for c in tracked))
    action = F.when(in_s & ~in_t, "inserted").when(in_s & differs, "updated").when(in_s, "unchanged").otherwise("kept")
    return both.select(
        *(F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in keys),
        *(F.when(in_s, new[c]).otherwise(F.col(f"t.{c}")).alias(c) for c in tracked),
        F.coalesce("t.created_at", now).alias("created_at"),
        F.when(action.isin("inserted", "updated"), now).otherwise(F.col("t.updated_at")).alias("updated_at"), action.alias("action"),
    )


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(*(F.sum(b2i(F.col("action") == a).cast("long")).alias(a) for a in ("inserted", "updated", "unchanged", "kept")))


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of source, one a key, and rows of target whose key source does not hold."""
    rest = target.alias("t").join(source.alias("s"), _on("t", "s", keys), "left_anti")
    return rest.unionByName(first_per_key(source, keys, order))


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """target, and the first row of source for each key that target lacks."""
    new = first_per_key(source, keys, order).alias("s").join(target.alias("t"), _on("s", "t", keys), "left_anti")
    return target.unionByName(new)


def replace_scope(target: DataFrame, source: DataFrame, scope: Sequence[str]) -> DataFrame:
    """source, and rows of target outside every scope that source holds; null is a scope value like any."""
    kept = target.alias("t").join(source.select(*scope).distinct().alias("s"), _on("t", "s", scope), "left_anti")
    return kept.unionByName(source)


def reset_where(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """columns set to null where the condition holds; an unknown condition does not hold."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(~hit, F.col(c)) for c in columns})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def patch_values(df: DataFrame, column: str, patches: DataFrame) -> DataFrame:
    """column replaced by patches (old, new), each old value once."""
    one = first_per_key(patches.select("old", "new"), ["old"], ["new"])
    return df.join(one, F.col(column) == F.col("old"), "left").withColumn(column, F.coalesce("new", column)).drop("old", "new")


def most_recent_flag(df: DataFrame, scope: Sequence[str], value: str, name: str) -> DataFrame:
    latest = df.groupBy(*(F.col(c).alias(f"__{c}") for c in scope)).agg(F.max(value).alias("__latest"))
    both = df.join(latest, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in scope])
    return both.select(*df.columns, b2i(F.col(value) == F.col("__latest")).alias(name))


def keep_last_groups(df: DataFrame, scope: Sequence[str], group: str, recency: str, n: int) -> DataFrame:
    """Rows of the n groups of each scope with the latest recency; ties go to the greater group."""
    seen = df.groupBy(*scope, group).agg(F.max(recency).alias("__seen"))
    nth = F.row_number().over(Window.partitionBy(*scope).orderBy(F.col("__seen").desc(), F.col(group).desc()))
    kept = seen.withColumn("__nth", nth).where(F.col("__nth") <= n).select(*scope, group)
    return df.join(kept, [*scope, group], "left_semi")


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with each named column, null where it was missing."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df without the named columns, whether it has them or not."""
    return df.drop(*columns)
