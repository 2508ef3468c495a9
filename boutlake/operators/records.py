"""Running records, flags of final matches, winners: windows over an athlete's season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i

SEASON = ("season", "wrestler_id")
STATE = "State Championships"
PLACES = ("1st Place Match", "3rd Place Match", "5th Place Match")


def win_pct(wins: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(wins / total * 100, 3))


def running_records(bouts: DataFrame) -> DataFrame:
    """bouts (season, wrestler_id, match_order, id, outcome, counts_in_record, is_varsity) with records so far.

    A null match_order comes first. One shuffle by athlete and season serves all sums.
    """
    so_far = Window.partitionBy(*SEASON).orderBy("match_order", "id").rowsBetween(Window.unboundedPreceding, 0)
    counted = F.col("counts_in_record") == 1
    varsity = counted & (F.col("is_varsity") == 1)
    run = lambda c: F.sum(b2i(c).cast("long")).over(so_far)
    sums = {f"{name}_run": run(counted & (F.col("outcome") == code)) for name, code in (("wins", "W"), ("losses", "L"), ("ties", "T"))}
    sums |= {f"{name}_var_run": run(varsity & (F.col("outcome") == code)) for name, code in (("wins", "W"), ("losses", "L"), ("ties", "T"))}
    df = bouts.withColumns(sums | {"total_matches": run(counted)})
    text = lambda tail, *names: F.concat(F.concat_ws("-", *(F.col(n).cast("string") for n in names)), F.lit(tail))
    return df.withColumns({
        "record": text(" W-L-T", "wins_run", "losses_run", "ties_run"),
        "record_varsity": text(" W-L-T (Varsity)", "wins_var_run", "losses_var_run", "ties_var_run"),
        "win_pct": win_pct(F.col("wins_run"), F.col("total_matches")),
    })


def priority_max(value: Column, *conditions: Column) -> Column:
    """The maximum of value under the first condition that any row meets, else over all rows."""
    return F.coalesce(*(F.max(F.when(c, value)) for c in conditions), F.max(value))


def final_flags(bouts: DataFrame) -> DataFrame:
    """bouts (…, round, event) with the last match by order and by placement, as 0/1 flags."""
    whole = Window.partitionBy(*SEASON)
    at_state = F.col("event").contains(STATE)
    placing = [F.col("round").contains(p) & at_state for p in PLACES]
    order = F.col("match_order")
    best = F.coalesce(*(F.max(F.when(c, order)).over(whole) for c in placing), F.max(order).over(whole))
    df = bouts.withColumns({"max_match_order": F.max(order).over(whole), "max_state_place_match_order": best})
    hit = F.lit(False)
    for c in placing:
        hit = hit | F.coalesce(c, F.lit(False))
    return df.withColumns({
        "is_final_match_by_order": b2i(order == F.col("max_match_order")),
        "is_final_match_by_state_place": b2i(order == F.col("max_state_place_match_order")),
        "is_final_match_state": b2i(hit | (at_state & (order == F.col("max_state_place_match_order")))),
    })


def winners(bouts: DataFrame) -> DataFrame:
    """bouts (outcome, wrestler_id, opponent_id, wrestler_name, opponent_name) with winner_id and winner_name."""
    won, lost = F.col("outcome") == "W", F.col("outcome") == "L"
    return bouts.withColumns({
        "winner_id": F.when(won, F.col("wrestler_id")).when(lost, F.col("opponent_id")),
        "winner_name": F.when(won, F.col("wrestler_name")).when(lost, F.col("opponent_name")).when(F.col("outcome") == "bye", "Bye"),
    })


def backfill_order(bouts: DataFrame) -> DataFrame:
    """match_order where null: the row's place among the athlete's rows by id."""
    return bouts.withColumn("match_order", F.coalesce("match_order", F.row_number().over(Window.partitionBy("wrestler_id").orderBy("id"))))
