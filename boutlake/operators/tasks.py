"""A task table and its transitions: each takes the table and returns the table.

tasks: task_set_id (where sets matter), task_id, status (PENDING, LOCKED, DONE, FAILED), attempt_count, locked_by, locked_at, updated_at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i

MOST_ATTEMPTS = 3
TTL_MINUTES = 30


def task_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 12)


def _set(tasks: DataFrame, hit: Column, values: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(hit, F.lit(False))
    return tasks.withColumn("__hit", hit).withColumns({c: F.when(F.col("__hit"), v).otherwise(F.col(c)) for c, v in values.items()}).drop("__hit")


def reclaim(tasks: DataFrame, now: Column, ttl_minutes: int = TTL_MINUTES) -> DataFrame:
    """Locks older than the limit are open again."""
    old = (F.col("status") == "LOCKED") & (F.col("locked_at") < now - F.make_dt_interval(mins=F.lit(ttl_minutes)))
    return _set(tasks, old, {"status": F.lit("PENDING"), "locked_by": F.lit(None).cast("string"), "locked_at": F.lit(None).cast("timestamp")})


def claim(tasks: DataFrame, worker: str, n: int, now: Column, most: int = MOST_ATTEMPTS) -> DataFrame:
    """The first n open tasks with attempts left go to a worker, by id."""
    open_ = F.coalesce((F.col("status") == "PENDING") & (F.col("attempt_count") < most), F.lit(False))
    first = tasks.where(open_).orderBy("task_id").limit(n).select("task_id", F.lit(True).alias("__mine"))
    both = tasks.join(first, "task_id", "left")
    return _set(both, F.col("__mine"), {"status": F.lit("LOCKED"), "attempt_count": F.col("attempt_count") + 1, "locked_by": F.lit(worker), "locked_at": now}).drop("__mine")


def finish(tasks: DataFrame, worker: str, failed: Column, now: Column, most: int = MOST_ATTEMPTS) -> DataFrame:
    """A worker's locked tasks are done; failed ones are open again until their attempts are used up."""
    mine = (F.col("status") == "LOCKED") & (F.col("locked_by") == worker)
    status = F.when(~failed, "DONE").when(F.col("attempt_count") >= most, "FAILED").otherwise("PENDING")
    return _set(tasks, mine, {"status": status, "locked_by": F.lit(None).cast("string"), "locked_at": F.lit(None).cast("timestamp"), "updated_at": now})


def select_tasks(tasks: DataFrame, task_set: str | None = None, statuses: Sequence[str] = (), worker: str | None = None, ids: Sequence[str] = ()) -> DataFrame:
    """Tasks under every condition given; one left out does not limit."""
    tests = [F.col("task_set_id") == task_set if task_set else None, F.col("status").isin(*statuses) if statuses else None, F.col("locked_by") == worker if worker else None, F.col("task_id").isin(*ids) if ids else None]
    return reduce(DataFrame.where, (t for t in tests if t is not None), tasks)


def seed(tasks: DataFrame, seeds: DataFrame, now: Column, reset: bool = False) -> DataFrame:
    """tasks with seeds (task_set_id, task_id): new ones are open, known ones keep their state but are updated now.

    With reset, every task of a seeded set is open again, without attempts or lock.
    """
    keys = ["task_set_id", "task_id"]
    both = tasks.join(seeds.select(keys).distinct().withColumn("__seed", F.lit(True)), keys, "full_outer")
    new = F.col("status").isNull()
    out = both.withColumns({
        "updated_at": F.when(F.col("__seed"), now).otherwise(F.col("updated_at")), "attempt_count": F.when(new, 0).otherwise(F.col("attempt_count")), "status": F.when(new, "PENDING").otherwise(F.col("status"))}).select(tasks.columns)
    if not reset:
        return out
    out = out.join(seeds.select("task_set_id", F.lit(True).alias("__again")).distinct(), "task_set_id", "left")
    out = _set(out, F.col("__again"), {"status": F.lit("PENDING"), "attempt_count": F.lit(0), "locked_by": F.lit(None).cast("string"), "locked_at": F.lit(None).cast("timestamp"), "updated_at": now})
    return out.select(tasks.columns)


def prune_sets(tasks: DataFrame, n: int = 3, scope: Sequence[str] = ()) -> DataFrame:
    """Tasks of the n sets of each scope that were updated last; of equal ones the greater name stays."""
    sets = tasks.groupBy(*scope, "task_set_id").agg(F.max("updated_at").alias("__seen"))
    last = Window.partitionBy(*scope).orderBy(F.col("__seen").desc(), F.col("task_set_id").desc())
    kept = sets.withColumn("__nth", F.row_number().over(last)).where(F.col("__nth") <= n)
    return tasks.join(kept.select(*scope, "task_set_id"), [*scope, "task_set_id"], "left_semi")


def progress(tasks: DataFrame, scope: str) -> DataFrame:
    """Tasks by status, and the time from the first to the last update as HH:MM:SS."""
    counts = [F.sum(b2i(F.col("status") == s).cast("long")).alias(s.lower()) for s in ("PENDING", "LOCKED", "DONE", "FAILED")]
    df = tasks.groupBy(scope).agg(F.count("*").alias("n"), *counts, (F.unix_timestamp(F.max("updated_at")) - F.unix_timestamp(F.min("updated_at"))).alias("seconds"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    hours = F.floor(F.col("seconds") / 3600).cast("string")
    return df.withColumn("duration", F.concat_ws(":", F.lpad(hours, F.greatest(F.lit(2), F.length(hours)), F.lit("0")), two(F.floor(F.col("seconds") % 3600 / 60)), two(F.col("seconds") % 60)))


def newest_first(tasks: DataFrame, scope: str) -> DataFrame:
    return tasks.withColumn("nth", F.row_number().over(Window.partitionBy(scope).orderBy(F.col("updated_at").desc(), "task_id")))
