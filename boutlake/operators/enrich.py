"""Attributes of teams and athletes joined to facts, each reference reduced to one row a key first."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i
from boutlake.functions.parse import one_line, opponent_from_line, result_of, team_after
from boutlake.operators.records import PLACES, STATE, priority_max
from boutlake.operators.upsert import first_per_key


def enrich(fact: DataFrame, ref: DataFrame, on: dict[str, str], columns: dict[str, str], order: Sequence[str]) -> DataFrame:
    """fact with reference columns under new names; on maps columns of fact to columns of ref.

    Rows of fact are neither lost nor repeated. The planner broadcasts the reference if it is small.
    """
    one = first_per_key(ref, list(on.values()), order).select(*(F.col(r).alias(f"__{r}") for r in on.values()), *(F.col(c).alias(n) for c, n in columns.items()))
    condition = [F.col(f) == F.col(f"__{r}") for f, r in on.items()]
    return fact.drop(*columns.values()).join(one, condition, "left").drop(*(f"__{r}" for r in on.values()))


def enrich_twice(fact: DataFrame, ref: DataFrame, own: dict[str, str], other: dict[str, str], columns: Sequence[str], prefixes: tuple[str, str], order: Sequence[str]) -> DataFrame:
    """One reference joined for both sides of a bout."""
    for on, prefix in zip((own, other), prefixes, strict=True):
        fact = enrich(fact, ref, on, {c: prefix + c for c in columns}, order)
    return fact


def backfill(df: DataFrame, ref: DataFrame, keys: Sequence[str], column: str, source: str = "source") -> DataFrame:
    """column where null: from ref by keys, else from other rows of df with the same keys (the least value).

    source tells where a value came from: given, reference, self or null.
    """
    by_ref = ref.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(column).alias("__ref"))
    by_self = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(column).alias("__self"))
    df = df.join(by_ref, list(keys), "left").join(by_self, list(keys), "left")
    origin = F.when(F.col(column).isNotNull(), "given").when(F.col("__ref").isNotNull(), "reference").when(F.col("__self").isNotNull(), "self")
    return df.withColumns({source: origin, column: F.coalesce(column, "__ref", "__self")}).drop("__ref", "__self")


def athletes_with_events(events: DataFrame, athletes: DataFrame, season: Sequence[str] = ("season", "category"), state: str | None = None) -> DataFrame:
    """Distinct athletes of teams with an event: by team_id, or by name where the event has no team_id.

    With state, only events of teams whose name holds a comma and that state ("North, CO") take part.

    Two equi-joins instead of one join with OR, whose plan would compare all pairs.
    """
    columns = athletes.columns
    if state is not None:
        events = events.where(F.col("team_name").contains(f", {state}"))
    by_id = events.where("team_id IS NOT NULL").select(*season, "team_id").distinct()
    by_name = events.where("team_id IS NULL").select(*season, F.col("team_name").alias("team")).distinct()
    found = athletes.join(by_id, [*season, "team_id"], "left_semi").select(columns)
    return found.unionByName(athletes.join(by_name, [*season, "team"], "left_semi").select(columns)).distinct()


def carry_forward(df: DataFrame, flags: DataFrame, key: str, flag_key: str, columns: Sequence[str]) -> DataFrame:
    """columns of flags over those of df where the key is found and the value is not null."""
    one = first_per_key(flags, [flag_key], list(columns)).select(F.col(flag_key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns))
    df = df.join(one, F.col(key) == F.col("__key"), "left")
    return df.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop("__key", *(f"__{c}" for c in columns))


def carry_everywhere(bouts: DataFrame, athletes: DataFrame, teams: DataFrame, columns: Sequence[str], team_columns: Sequence[str]) -> DataFrame:
    """Flags of athletes (wrestler_id, columns) and teams (team_id, team_columns) carried to both sides of each bout.

    The other side's columns have the prefix opponent_; values stay where no flag is found.
    """
    for ref, key, names in ((athletes, "wrestler_id", columns), (teams, "team_id", team_columns)):
        bouts = carry_forward(bouts, ref, key, key, names)
        other = {"wrestler_id": "opponent_id", "team_id": "opponent_team_id"}[key]
        flags = ref.select(F.col(key).alias("__id"), *(F.col(c).alias(f"opponent_{c}") for c in names))
        bouts = carry_forward(bouts, flags, other, "__id", [f"opponent_{c}" for c in names])
    return bouts


def with_aliases(people: DataFrame, aliases: DataFrame) -> DataFrame:
    """people (team) with team_canonical from aliases (team_raw, team_canonical), else the team itself.

    A team with several aliases gives a row for each.
    """
    both = people.join(aliases.select(F.col("team_raw").alias("__raw"), "team_canonical"), F.col("team") == F.col("__raw"), "left")
    return both.withColumn("team_canonical", F.coalesce("team_canonical", "team")).drop("__raw")


def division_of(event: Column) -> Column:
    """The first of 1A to 5A that an event's name holds, ignoring case, else unknown."""
    out = F.when(F.upper(event).contains("1A"), "1A")
    for d in ("2A", "3A", "4A", "5A"):
        out = out.when(F.upper(event).contains(d), d)
    return out.otherwise("unknown")


def regional_divisions(bouts: DataFrame, teams: DataFrame) -> DataFrame:
    """teams (team_id, …) with event, team_division and team_region of regional events in bouts (season, event, team, team_id).

    A regional event names CHSAA, Region and a division; its region is the text after its last "A". Teams meet
    events by team_id alone and get a row for each season's event and name they went by; teams without any
    read no_regional_event, unknown, unknown.
    """
    name = F.upper("event")
    rows = bouts.where(name.contains("CHSAA") & name.contains("REGION")).select("season", "event", "team", "team_id").distinct()
    rows = rows.select(F.col("team_id").alias("__id"), "event", division_of(F.col("event")).alias("team_division"), F.trim(F.substring_index("event", "A", -1)).alias("team_region"))
    both = teams.join(rows.where("team_division <> 'unknown'"), F.col("team_id") == F.col("__id"), "left").drop("__id")
    return both.fillna({"event": "no_regional_event", "team_division": "unknown", "team_region": "unknown"}, ["event", "team_division", "team_region"])


def placement(season: Column, round_: Column, outcome: Column, done: dict[str, str]) -> Column:
    """State place from the deciding round and its outcome, as "1st_state_place_2025"; "other_2025" otherwise, "tbd" for seasons not in done (season → year)."""
    out = F.lit("tbd")
    for name, year in done.items():
        place = F.lit(f"other_{year}")
        for text, won, lost in (("5th", "5th", "6th"), ("3rd", "3rd", "4th"), ("1st", "1st", "2nd")):
            at = F.coalesce(round_.contains(f"{text} Place Match"), F.lit(False))
            place = F.when(at & (outcome == "W"), f"{won}_state_place_{year}").when(at & (outcome == "L"), f"{lost}_state_place_{year}").otherwise(place)
        out = F.when(season == name, place).otherwise(out)
    return out


def final_state_bouts(bouts: DataFrame, done: dict[str, str], keys: Sequence[str] = ("season", "wrestler_id")) -> DataFrame:
    """The deciding State bout of each athlete's season: placement rounds first, else the last one; ties keep all rows.

    bouts: keys, match_order, event, round, weight_category, outcome. Only bouts at State Championships in a
    weight category with an "A" take part. Rows gain is_state_tournament_qualifier, place and count_matches.
    """
    at_state = bouts.where(F.col("event").contains(STATE) & F.col("weight_category").contains("A"))
    last = at_state.groupBy(*keys).agg(priority_max(F.col("match_order"), *(F.col("round").contains(p) for p in PLACES)).alias("match_order"), F.count("*").alias("count_matches"))
    qualifier = F.lit("other")
    for season, year in done.items():
        qualifier = F.when(F.col("season") == season, f"state_qualifier_{year}").otherwise(qualifier)
    return at_state.join(last, [*keys, "match_order"]).withColumns({"is_state_tournament_qualifier": qualifier, "place": placement(F.col("season"), F.col("round"), F.col("outcome"), done)})


def with_opponents(bouts: DataFrame, athletes: DataFrame) -> DataFrame:
    """bouts (wrestler_id, opponent_id, raw_details) with own_name, opponent_name and opponent_team.

    athletes (wrestler_id, name, team), a row a key, is joined for both sides. An opponent who is not listed, or lacks a
    name or team, is read from the line, unless the result is a bye or the opponent has no id; the own side
    is found by the listed name. A team of three characters or fewer counts only if it is listed.
    """
    rows = enrich(bouts, athletes, {"wrestler_id": "wrestler_id"}, {"name": "own_name"}, ["name", "team"])
    rows = enrich(rows, athletes, {"opponent_id": "wrestler_id"}, {"name": "__name", "team": "__team"}, ["name", "team"])
    line = one_line(F.col("raw_details"))
    readable = F.col("opponent_id").isNotNull() & ~F.coalesce(result_of(line) == "bye", F.lit(False))
    rows = rows.withColumn("opponent_name", F.coalesce("__name", F.when(readable, opponent_from_line(F.col("raw_details"), F.col("own_name")))))
    rows = rows.withColumn("opponent_team", F.coalesce("__team", F.when(readable, team_after(F.col("raw_details"), F.col("opponent_name")))))
    return rows.drop("__name", "__team")


def latest_by_group(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    """value of the row with the greatest order in each group."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))).alias(value))


def cross_season_summary(athletes: DataFrame, seasons: tuple[str, str]) -> DataFrame:
    """One row for each name: ids by season as lists, how many, and whether each season has exactly one."""
    ids = [F.array_sort(F.collect_set(F.when(F.col("season") == s, F.col("wrestler_id")))) for s in seasons]
    teams = F.array_join(F.array_sort(F.collect_set("team")), ",")
    df = athletes.groupBy("name").agg(teams.alias("teams"), *(i.alias(f"ids_{k}") for k, i in enumerate(ids)))
    counts = {f"n_ids_{k}": F.size(f"ids_{k}").cast("long") for k in range(2)}
    df = df.withColumns(counts | {f"ids_{k}": F.array_join(F.transform(f"ids_{k}", lambda x: x.cast("string")), ",") for k in range(2)})
    return df.withColumn("one_to_one", b2i((F.col("n_ids_0") == 1) & (F.col("n_ids_1") == 1)))


def carried_flags(summary: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """summary (ids_1, n_ids_0, n_ids_1, columns) → wrestler_id and columns of people with exactly one id in each season.

    The id is the first of the later season's list. With required, those columns are not null either. Equal rows once.
    """
    rows = summary.where("n_ids_0 = 1 AND n_ids_1 = 1 AND ids_1 <> ''")
    for c in required:
        rows = rows.where(F.col(c).isNotNull())
    return rows.select(F.substring_index("ids_1", ",", 1).try_cast("long").alias("wrestler_id"), *columns).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_unique(df: DataFrame, keys: Sequence[str], abort: bool = True) -> DataFrame:
    """df if no key has two rows; else an error with some of the keys, or with abort=False a warning."""
    twice = duplicate_keys(df, keys).limit(5).collect()
    if twice:
        text = f"rows share keys {list(keys)}: " + "; ".join(str(tuple(r)) for r in twice)
        if abort:
            raise ValueError(text)
        warnings.warn(text, stacklevel=2)
    return df


def concat_by(df: DataFrame, keys: Sequence[str], value: str, order: str, sep: str = ",") -> DataFrame:
    """Distinct values of each group in one text, in the least order that each has, then by value."""
    one = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("__o"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("__o").alias("o"), F.col(value).cast("string").alias("v"))))
    return one.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["v"]), sep).alias(value))


def with_team_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n_teams of each event, and whether two teams make it a dual."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumns({"n_teams": n, "is_dual": b2i(n == 2)})
