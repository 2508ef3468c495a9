"""Ranking documents: state carried from line to line.

A document is a sequence of lines. A division's header sets the division and ends the weight; a weight's header, only
under a division, sets the weight and starts the ranks anew; any other line under both is an entry if it
names an athlete and a school. Documents of week 0 and of later weeks are written differently:

* week 0: "Class 4A" anywhere in a line is a division, "106 lbs…" at its start a weight of any size.
* later: a line that begins with 2A to 5A, after "Class" or not, is a division; "106lbs…" at a line's start or a
  number of two or three digits alone is a weight between 90 and 300, unless the line is one of a numbered
  list ("15-Crowley County"); numbers before names ("1. Ann Lee, North") are left out.

The state is the last header before each line, taken with windows, so a document of any length needs no loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers of the two kinds of documents, and weights in pounds that a later ranking may be about.
DIVISION_WEEK_0 = r"(?i)Class\s+(\dA)\b"
DIVISION_LATER = r"(?i)^(?:Class[\s_-]*)?(2A|3A|4A|5A)\b"
WEIGHT_WEEK_0 = r"(?i)^(\d+)\s*lb[s]?\b"
WEIGHT_LATER = r"(?i)^(\d{2,3})(?:\s*lb[s]?\b|$)"
LISTED = r"^\d{1,2}\s*[-.]"
WEIGHTS = (90, 300)


def week_of(name: Column) -> Column:
    """The number after "week" in a file's name; null without one."""
    return F.regexp_extract(name, r"(?i)week[\s_-]?(\d+)(?:\b|_)", 1).try_cast("int")


def _trimmed(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _found(line: Column, pattern: str) -> Column:
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, 1))


def ranking_entries(lines: DataFrame, document: Sequence[str] = ("source_file",)) -> DataFrame:
    """lines (document's columns, week, line_no, line) → document's columns, week, division, weight, rank, name, school, line.

    A null week counts as 0. Lines are trimmed, empty and null ones skipped.
    """
    line = _trimmed(F.col("line"))
    rows = lines.select(*document, F.coalesce("week", F.lit(0)).cast("int").alias("week"), "line_no", line.alias("line")).where("line <> ''")
    first = F.col("week") == 0
    text = F.col("line")
    before = Window.partitionBy(*document).orderBy("line_no")
    division = F.upper(F.when(first, _found(text, DIVISION_WEEK_0)).otherwise(_found(text, DIVISION_LATER)))
    rows = rows.withColumn("header", division).withColumn("division", F.last("header", True).over(before))
    # One long enough to be beyond a number's range is no weight of later weeks, and null is none of week 0.
    later = F.when(~text.rlike(LISTED), _found(text, WEIGHT_LATER).try_cast("int"))
    weight = F.when(first, _found(text, WEIGHT_WEEK_0).try_cast("int")).otherwise(F.when(later.between(*WEIGHTS), later))
    rows = rows.withColumn("set", F.when(F.col("header").isNull() & F.col("division").isNotNull(), weight))
    is_header = F.col("header").isNotNull() | F.col("set").isNotNull()
    rows = rows.withColumns({"is_header": is_header, "section": F.count_if(is_header).over(before), "state": F.last(F.when(is_header, F.struct("set")), True).over(before)})
    prefix = F.regexp_replace(_trimmed(F.substring_index("line", "(", 1)), ";$", "")
    at = F.instr(prefix, ",")
    name = _trimmed(F.substr(prefix, F.lit(1), at - 1))
    name = F.when(first, name).otherwise(_trimmed(F.regexp_replace(name, r"^\d+\.\s*", "")))
    rows = rows.where(~F.col("is_header") & F.col("state.set").isNotNull() & text.contains(",") & (at > 0))
    rows = rows.withColumns({"name": name, "school": _trimmed(F.substr(prefix, at + 1))}).where("name <> '' AND school <> ''")
    rank = F.row_number().over(Window.partitionBy(*document, "section").orderBy("line_no"))
    return rows.select(*document, "week", "division", F.col("state.set").alias("weight"), rank.alias("rank"), "name", "school", "line")


def with_latest_week(rankings: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """rankings with is_most_recent_ranked_week: 1 for the greatest week of its scope."""
    latest = rankings.groupBy(*scope).agg(F.max("week").alias("__latest"))
    both = rankings.join(F.broadcast(latest), F.lit(True), "left") if not scope else rankings.join(latest, list(scope), "left")
    return both.withColumn("is_most_recent_ranked_week", F.when(F.col("week") == F.col("__latest"), 1).otherwise(0)).drop("__latest")
