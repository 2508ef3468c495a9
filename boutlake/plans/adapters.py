"""Views of the driver's tables as bouts; each expression reads the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Columns of bouts over events.
BOUT = {
    "id": "event_id",
    "wrestler_id": "user_id",
    "opponent_id": "(user_id * 7 + event_id) % 150",
    "season": "CASE WHEN day(ts) <= 15 THEN 'early' ELSE 'late' END",
    "outcome": "CASE event_type WHEN 'purchase' THEN 'W' WHEN 'error' THEN 'L' WHEN 'signup' THEN 'T' WHEN 'view' THEN 'bye' ELSE 'U' END",
    "counts_in_record": "CASE WHEN event_type = 'view' THEN 0 ELSE 1 END",
    "is_varsity": "CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END",
    "round": "CASE event_id % 8 WHEN 0 THEN '1st Place Match' WHEN 1 THEN '3rd Place Match' WHEN 2 THEN 'Semifinal' WHEN 3 THEN 'Cons. Round 2' WHEN 4 THEN NULL WHEN 5 THEN '5th Place Match' ELSE concat('Round ', event_id % 5) END",
    "event": "CASE WHEN event_id % 5 = 0 THEN 'State Championships' WHEN event_id % 5 = 1 THEN 'North vs. South' ELSE 'Winter Open' END",
    "start": "ts",
}
BOUTS_SQL = "SELECT *, row_number() OVER (PARTITION BY wrestler_id ORDER BY start, id) AS match_order FROM (SELECT " + ", ".join(f"{e} AS {n}" for n, e in BOUT.items()) + " FROM events)"

ME = "concat('User', user_id, ' Van Der Berg')"
YOU = "concat('User', (user_id * 7 + event_id) % 150, ' O''Neil Jr.')"
MINE, YOURS = "concat('Club', user_id % 20)", "concat('Town', event_id % 30)"
FIRST, SECOND = f"{ME}, ' (', {MINE}, ')'", f"{YOU}, ' (', {YOURS}, ')'"
#: One text for each branch that the parser has.
LINES = (
    f"concat('Varsity - Final - ', {FIRST}, ' over ', {SECOND}, ' (Dec 5-2)')",
    f"concat('Cons. Round 1 - ', {SECOND}, ' over ', {FIRST}, ' (Fall 1:20)')",
    f"concat('Quarterfinal - ', {ME}, ' received a bye')",
    f"concat('JV - ', {SECOND}, ' over ', {FIRST}, ' (MFF)')",
    f"concat({FIRST}, ' over ', {SECOND}, ' (For.)')",
    f"concat('Exhibition - ', {FIRST}, ' over ', {SECOND}, ' (Maj 10-1)')",
    f"concat('Round 2 - ', {FIRST}, ' and ', {SECOND}, ' wrestled to a draw (3-3)')",
    f"concat('Round 3 - ', {ME}, ' over Unknown (For.)')",
    f"concat('Dual - ', {FIRST}, ' vs. ', {SECOND})",
    "concat('Round 4 - Somebody (Elsewhere) over Nobody (Nowhere) (DQ)')",
    f"concat('Round 5 - Berg (', {MINE}, ') over ', {SECOND}, ' (Inj. Def. 0:30)')",
    "NULL",
    "''",
)
BOUT_TEXT = {
    "id": "event_id",
    "wrestler_id": "user_id",
    "wrestler_name": f"CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE {ME} END",
    "wrestler_team": f"concat({MINE}, ', CO')",
    "opponent_id": "CASE WHEN event_id % 7 > 0 THEN (user_id * 7 + event_id) % 150 END",
    "raw_details": f"CASE event_id % {len(LINES)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(LINES)) + " END",
}
BOUT_TEXT_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in BOUT_TEXT.items()) + " FROM events"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").selectExpr(*(f"{e} AS {n}" for n, e in BOUT.items()))
    return rows.selectExpr("*", "CAST(row_number() OVER (PARTITION BY wrestler_id ORDER BY start, id) AS BIGINT) AS match_order")


def bout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*(f"{e} AS {n}" for n, e in BOUT_TEXT.items()))
