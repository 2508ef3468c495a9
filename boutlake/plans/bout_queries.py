"""Queries over bouts and bout lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlake.functions import parse
from boutlake.functions.compat import soundex_full
from boutlake.operators import enrich, matching, ratings, records, reports
from boutlake.plans.adapters import BOUT_TEXT_SQL, BOUTS_SQL, bout_text, bouts, read

RUN = "OVER (PARTITION BY season, wrestler_id ORDER BY match_order, id ROWS UNBOUNDED PRECEDING)"


def running_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = records.running_records(bouts(spark, sf_dir))
    return df.select("id", "season", "wrestler_id", "match_order", "outcome", "wins_run", "losses_run", "ties_run", "wins_var_run", "losses_var_run", "ties_var_run", "total_matches", "win_pct", "record", "record_varsity")


def _run(cond: str) -> str:
    return f"CAST(sum(CASE WHEN counts_in_record = 1 AND {cond} THEN 1 ELSE 0 END) {RUN} AS BIGINT)"


RUNNING_RECORD = f"""
WITH b AS ({BOUTS_SQL}), r AS (SELECT *, {_run("outcome = 'W'")} AS wins_run, {_run("outcome = 'L'")} AS losses_run, {_run("outcome = 'T'")} AS ties_run,
  {_run("is_varsity = 1 AND outcome = 'W'")} AS wins_var_run, {_run("is_varsity = 1 AND outcome = 'L'")} AS losses_var_run, {_run("is_varsity = 1 AND outcome = 'T'")} AS ties_var_run,
  {_run("true")} AS total_matches FROM b)
SELECT id, season, wrestler_id, match_order, outcome, wins_run, losses_run, ties_run, wins_var_run, losses_var_run, ties_var_run, total_matches,
  CASE WHEN total_matches > 0 THEN round(wins_run / total_matches * 100, 3) END AS win_pct,
  concat(wins_run, '-', losses_run, '-', ties_run, ' W-L-T') AS record, concat(wins_var_run, '-', losses_var_run, '-', ties_var_run, ' W-L-T (Varsity)') AS record_varsity FROM r
"""


def final_match_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = records.final_flags(bouts(spark, sf_dir))
    return df.select("id", "max_match_order", "max_state_place_match_order", "is_final_match_by_order", "is_final_match_by_state_place", "is_final_match_state")


_P = "OVER (PARTITION BY season, wrestler_id)"
_AT = [f"(round LIKE '%{p}%' AND event LIKE '%State Championships%')" for p in records.PLACES]
FINAL_MATCH_FLAGS = f"""
WITH b AS ({BOUTS_SQL}), m AS (SELECT *, max(match_order) {_P} AS max_match_order,
  coalesce({", ".join(f"max(CASE WHEN {c} THEN match_order END) {_P}" for c in _AT)}, max(match_order) {_P}) AS max_state_place_match_order FROM b)
SELECT id, max_match_order, max_state_place_match_order, CAST(match_order = max_match_order AS INT) AS is_final_match_by_order,
  CAST(match_order = max_state_place_match_order AS INT) AS is_final_match_by_state_place,
  CASE WHEN {" OR ".join(_AT)} OR (event LIKE '%State Championships%' AND match_order = max_state_place_match_order) THEN 1 ELSE 0 END AS is_final_match_state FROM m
"""


def parse_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bout_text(spark, sf_dir).select("id", parse.round_of(parse.one_line(F.col("raw_details"))).alias("round"))


_LEVEL = "lower(trim(split_part(l, ' - ', 1))) IN ('varsity', 'jv', 'junior varsity', 'exhibition', 'scrimmage')"
_LINES = f"t AS ({BOUT_TEXT_SQL}), x AS (SELECT *, trim(translate(raw_details, chr(13) || chr(10), '  ')) AS l FROM t)"
PARSE_ROUND = f"""
WITH {_LINES}
SELECT id, CASE WHEN l IS NULL OR strpos(l, ' - ') = 0 THEN NULL WHEN {_LEVEL} AND strpos(split_part(l, ' - ', 2), '(') = 0 THEN trim(split_part(l, ' - ', 2))
  WHEN strpos(split_part(l, ' - ', 1), '(') = 0 THEN trim(split_part(l, ' - ', 1)) END AS round FROM x
"""


def parse_result_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = parse.one_line(F.col("raw_details"))
    return bout_text(spark, sf_dir).select("id", parse.result_of(line).alias("result"), parse.score_of(line).alias("score_details"))


PARSE_RESULT_SCORE = rf"""
WITH {_LINES}
SELECT id, CASE WHEN regexp_matches(lower(l), '\breceived a bye\b') THEN 'bye' WHEN strpos(lower(l), ' over ') > 0 THEN 'over' END AS result,
  CASE WHEN strpos(lower(l), ' vs. ') > 0 THEN 'vs. no winner info' WHEN strpos(lower(l), 'received a bye') > 0 THEN 'Bye'
  WHEN strpos(l, '(') > 0 THEN rtrim(split_part(l, '(', -1), ')') END AS score_details FROM x
"""


def parse_sides_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parse.with_bout(bout_text(spark, sf_dir))
    return df.select("id", "me_before", "me_after", "is_bye", "is_exhibition", "is_tie", "is_unknown_forfeit", "is_forfeit", "is_varsity", "outcome", "counts_in_record")


def _names(half: str) -> str:
    return f"""CASE WHEN me <> '' AND {half} IS NOT NULL AND (strpos({half}, me) > 0 OR strpos({half}, club) > 0) THEN 1 ELSE 0 END"""


PARSE_SIDES_OUTCOME = rf"""
WITH {_LINES}, h AS (SELECT *, lower(l) AS w, lower(wrestler_name) AS me, lower(trim(split_part(wrestler_team, ',', 1))) AS club FROM x),
s AS (SELECT *, CASE WHEN strpos(w, ' over ') > 0 THEN substr(w, 1, strpos(w, ' over ') - 1) END AS b, CASE WHEN strpos(w, ' over ') > 0 THEN substr(w, strpos(w, ' over ') + 6) END AS a FROM h),
f AS (SELECT id, {_names("b")} AS me_before, {_names("a")} AS me_after,
  CASE WHEN regexp_matches(w, '\breceived a bye\b') OR strpos(w, ' bye') > 0 THEN 1 ELSE 0 END AS is_bye,
  CASE WHEN strpos(w, 'exhibition') > 0 THEN 1 ELSE 0 END AS is_exhibition,
  CASE WHEN strpos(w, ' tie') > 0 OR strpos(w, ' draw') > 0 THEN 1 ELSE 0 END AS is_tie,
  CASE WHEN regexp_matches(w, '\bover\s+unknown\s*\(\s*for\.\s*\)') THEN 1 ELSE 0 END AS is_unknown_forfeit,
  CASE WHEN regexp_matches(w, ' forfeit| for\.| fft|injury default|\bmff\b|\bmed(?:ical)?\s*for(?:feit)?\b|\binj\.?\s*def\.?(?:\b|\s|\)|$)|\b(?:dq|disqualification)\b') THEN 1 ELSE 0 END AS is_forfeit,
  CASE WHEN strpos(w, 'varsity') > 0 THEN 1 ELSE 0 END AS is_varsity FROM s)
SELECT *, CASE WHEN is_bye = 1 THEN 'bye' WHEN is_exhibition = 1 THEN 'U' WHEN is_tie = 1 THEN 'T' WHEN is_unknown_forfeit = 1 THEN 'W'
  WHEN me_before > me_after THEN 'W' WHEN me_before < me_after THEN 'L' ELSE 'U' END AS outcome, 1 - greatest(is_bye, is_exhibition) AS counts_in_record FROM f
"""


def parse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, other = parse.clean_name(F.col("wrestler_name")), parse.clean_name(parse.opponent_from_line(F.col("raw_details"), F.col("wrestler_name")))
    df = bout_text(spark, sf_dir).select("id", own.alias("w"), other.alias("o"))
    return df.select("id", *(f(F.col(c)).alias(f"{p}_{n}") for c, p in (("w", "wrestler"), ("o", "opponent")) for f, n in ((parse.first_name, "first_name"), (parse.last_name, "last_name"))))


_OPPONENT = """CASE WHEN strpos(raw_details, ' over ') = 0 THEN NULL
  WHEN strpos(lower(substr(raw_details, 1, strpos(raw_details, ' over ') - 1)), lower(wrestler_name)) > 0 THEN trim(split_part(split_part(substr(raw_details, strpos(raw_details, ' over ') + 6), ' (', 1), ' - ', -1))
  WHEN strpos(lower(substr(raw_details, strpos(raw_details, ' over ') + 6)), lower(wrestler_name)) > 0 THEN trim(split_part(split_part(substr(raw_details, 1, strpos(raw_details, ' over ') - 1), ' (', 1), ' - ', -1)) END"""


def _clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({c}, '\s*\([^)]*\)\s*$', ''), '\s*,?\s*(?:Jr\.?|Sr\.?|II|III|IV|V|VI)\s*$', ''))"


def _last(c: str) -> str:
    n = f"string_split({c}, ' ')"
    tail = lambda k: f"array_to_string({n}[-{k}:], ' ')"
    return rf"""CASE WHEN regexp_matches({tail(3)}, '(?i)^(?:de la|van der|von der)\s+\S+$') THEN {tail(3)}
  WHEN regexp_matches({tail(2)}, '(?i)^(?:de|da|del|der|di|du|van|von|la|le|st\.?|san)\s+\S+$') THEN {tail(2)} ELSE {tail(1)} END"""


PARSE_NAMES = f"""
WITH t AS ({BOUT_TEXT_SQL}), n AS (SELECT id, {_clean("wrestler_name")} AS w, {_clean("(" + _OPPONENT + ")")} AS o FROM t),
l AS (SELECT *, {_last("w")} AS wl, {_last("o")} AS ol FROM n)
SELECT id, trim(substr(w, 1, length(w) - length(wl))) AS wrestler_first_name, wl AS wrestler_last_name, trim(substr(o, 1, length(o) - length(ol))) AS opponent_first_name, ol AS opponent_last_name FROM l
"""


def opponent_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers are listed; those of one segment lack a name, and some lines have no opponent's id."""
    listed = read(spark, sf_dir, "customer").selectExpr("c_custkey AS wrestler_id", f"CASE WHEN c_custkey % 3 = 0 THEN {_LISTED} WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name", "CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS team")
    return enrich.with_opponents(bout_text(spark, sf_dir), listed).select("id", "own_name", "opponent_name", "opponent_team")


#: A third of the customers are listed under the name that lines give them.
_LISTED = "concat('User', c_custkey, ' Van Der Berg')"
_BEFORE, _AFTER = "substr(raw_details, 1, strpos(raw_details, ' over ') - 1)", "substr(raw_details, strpos(raw_details, ' over ') + 6)"
OPPONENT_RESOLUTION = rf"""
WITH t AS ({BOUT_TEXT_SQL}), c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN {_LISTED} WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS team FROM customer),
j AS (SELECT t.*, l.name AS own_name, o.name AS o_name, o.team AS o_team, regexp_matches(lower(raw_details), 'received a bye') AS bye FROM t LEFT JOIN c l ON l.c_custkey = wrestler_id LEFT JOIN c o ON o.c_custkey = opponent_id),
n AS (SELECT *, coalesce(o_name, CASE WHEN bye OR opponent_id IS NULL OR strpos(raw_details, ' over ') = 0 THEN NULL
  WHEN strpos(lower({_BEFORE}), lower(own_name)) > 0 THEN trim(split_part(split_part({_AFTER}, ' (', 1), ' - ', -1))
  WHEN strpos(lower({_AFTER}), lower(own_name)) > 0 THEN trim(split_part(split_part({_BEFORE}, ' (', 1), ' - ', -1)) END) AS opponent_name FROM j),
g AS (SELECT *, CASE WHEN bye OR opponent_id IS NULL OR opponent_name IS NULL OR strpos(raw_details, opponent_name) = 0 THEN NULL
  ELSE trim(regexp_extract(substr(raw_details, strpos(raw_details, opponent_name) + length(opponent_name)), '\(([^)]*)\)', 1)) END AS team FROM n)
SELECT id, own_name, opponent_name, coalesce(o_team, CASE WHEN length(team) > 3 THEN team END) AS opponent_team FROM g
"""


def winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bouts(spark, sf_dir).withColumns({"wrestler_name": F.concat(F.lit("User"), "wrestler_id"), "opponent_name": F.concat(F.lit("User"), "opponent_id")})
    return records.winners(df).select("id", "winner_id", "winner_name", parse.event_type(F.col("event")).alias("event_type"))


WINNER = f"""
SELECT id, CASE outcome WHEN 'W' THEN wrestler_id WHEN 'L' THEN opponent_id END AS winner_id,
  CASE outcome WHEN 'W' THEN concat('User', wrestler_id) WHEN 'L' THEN concat('User', opponent_id) WHEN 'bye' THEN 'Bye' END AS winner_name,
  CASE WHEN event ILIKE '%vs%' THEN 'dual' WHEN event IS NOT NULL THEN 'tournament' ELSE 'other' END AS event_type FROM ({BOUTS_SQL})
"""


_WEIGHT = "CASE WHEN id % 3 = 0 THEN '120' ELSE concat(wrestler_id % 5 + 1, 'A 120') END"
_DONE = {"early": "2025"}


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bouts; two of three are in a weight category of a division, and one season's places are known."""
    return enrich.final_state_bouts(bouts(spark, sf_dir).withColumn("weight_category", F.expr(_WEIGHT)), _DONE)


def priority_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir).select("season", "wrestler_id", "match_order", "id", "is_state_tournament_qualifier", "place", "count_matches")


PRIORITY_ARGMAX = f"""
WITH d AS (SELECT *, CASE WHEN season = 'early' THEN 'state_qualifier_2025' ELSE 'other' END AS is_state_tournament_qualifier,
  CASE WHEN season = 'early' AND round LIKE '%1st Place Match%' AND outcome = 'W' THEN '1st_state_place_2025' WHEN season = 'early' AND round LIKE '%1st Place Match%' AND outcome = 'L' THEN '2nd_state_place_2025'
    WHEN season = 'early' AND round LIKE '%3rd Place Match%' AND outcome = 'W' THEN '3rd_state_place_2025' WHEN season = 'early' AND round LIKE '%3rd Place Match%' AND outcome = 'L' THEN '4th_state_place_2025'
    WHEN season = 'early' AND round LIKE '%5th Place Match%' AND outcome = 'W' THEN '5th_state_place_2025' WHEN season = 'early' AND round LIKE '%5th Place Match%' AND outcome = 'L' THEN '6th_state_place_2025'
    WHEN season = 'early' THEN 'other_2025' ELSE 'tbd' END AS place
  FROM (SELECT *, {_WEIGHT} AS weight_category FROM ({BOUTS_SQL})) WHERE event LIKE '%State Championships%' AND weight_category LIKE '%A%'),
m AS (SELECT season, wrestler_id, coalesce(max(CASE WHEN round LIKE '%1st Place Match%' THEN match_order END), max(CASE WHEN round LIKE '%3rd Place Match%' THEN match_order END),
  max(CASE WHEN round LIKE '%5th Place Match%' THEN match_order END), max(match_order)) AS match_order, count(*) AS count_matches FROM d GROUP BY ALL)
SELECT season, wrestler_id, match_order, id, is_state_tournament_qualifier, place, count_matches FROM d JOIN m USING (season, wrestler_id, match_order)
"""


def pair_head_to_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everyone who met, the lesser id in the first place; State finals do not count."""
    df = bouts(spark, sf_dir)
    pairs = df.where("wrestler_id <> opponent_id").select(F.least("wrestler_id", "opponent_id").alias("first_place_id"), F.greatest("wrestler_id", "opponent_id").alias("second_place_id")).distinct()
    return reports.head_to_head(pairs, df, F.col("event").contains("State Championships") & F.col("round").contains("1st Place Match"))


_SERIES = """CASE WHEN n IS NULL OR n = 0 THEN 'no_prior_meeting' WHEN w1 > w2 THEN 'first_place_led_series' WHEN w2 > w1 THEN 'second_place_led_series' ELSE 'series_tied' END AS prior_series_summary"""
_PRIOR = """coalesce(n, 0) AS prior_meet_count, coalesce(w1, 0) AS first_place_prior_wins, coalesce(w2, 0) AS second_place_prior_wins, """ + _SERIES
_MET = """count(*) AS n, count(*) FILTER (WHERE h.wrestler_id = p.first_place_id AND h.outcome = 'W') AS w1, count(*) FILTER (WHERE h.wrestler_id = p.second_place_id AND h.outcome = 'W') AS w2"""
_NOT_FINAL = "NOT (h.event LIKE '%State Championships%' AND coalesce(h.round, '') LIKE '%1st Place Match%')"
PAIR_HEAD_TO_HEAD = f"""
WITH h AS ({BOUTS_SQL}), p AS (SELECT DISTINCT least(wrestler_id, opponent_id) AS first_place_id, greatest(wrestler_id, opponent_id) AS second_place_id FROM h WHERE wrestler_id <> opponent_id),
m AS (SELECT first_place_id, second_place_id, {_MET} FROM p JOIN h ON least(h.wrestler_id, h.opponent_id) = first_place_id AND greatest(h.wrestler_id, h.opponent_id) = second_place_id WHERE {_NOT_FINAL} GROUP BY ALL)
SELECT first_place_id, second_place_id, {_PRIOR} FROM p LEFT JOIN m USING (first_place_id, second_place_id)
"""


def finalist_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Athletes compete in five brackets; every fourth bout is at State, half of these are finals."""
    df = bouts(spark, sf_dir).withColumns({"weight_category": F.concat(F.col("wrestler_id") % 5, F.lit("A")), "event": F.when(F.col("id") % 4 == 0, "State Championships").otherwise("Winter Open")})
    return reports.finalist_report(df)


FINALIST_REPORT = f"""
WITH h AS (SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN 'State Championships' ELSE 'Winter Open' END AS event), concat(wrestler_id % 5, 'A') AS weight_category FROM ({BOUTS_SQL})),
d AS (SELECT *, CASE WHEN round LIKE '%1st Place Match%' AND outcome = 'W' THEN 1 WHEN round LIKE '%1st Place Match%' AND outcome = 'L' THEN 2 END AS place FROM h WHERE event LIKE '%State Championships%' AND weight_category LIKE '%A%'),
x AS (SELECT season, wrestler_id, max(match_order) AS match_order FROM d GROUP BY ALL), e AS (SELECT d.* FROM d JOIN x USING (season, wrestler_id, match_order)),
p AS (SELECT a.season, a.weight_category, a.wrestler_id AS first_place_id, b.wrestler_id AS second_place_id FROM e a JOIN e b ON a.season = b.season AND a.weight_category = b.weight_category AND a.place = 1 AND b.place = 2),
m AS (SELECT p.season, p.weight_category, first_place_id, second_place_id, {_MET} FROM p JOIN h ON h.season = p.season
  AND ((h.wrestler_id = first_place_id AND h.opponent_id = second_place_id) OR (h.wrestler_id = second_place_id AND h.opponent_id = first_place_id)) WHERE {_NOT_FINAL} GROUP BY ALL)
SELECT season, weight_category, first_place_id, second_place_id, {_PRIOR} FROM p LEFT JOIN m USING (season, weight_category, first_place_id, second_place_id)
"""


def finalist_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(spark, sf_dir).withColumn("bracket", F.col("wrestler_id") % 2)
    return reports.finalist_pairs(placed, ["season", "bracket"])


FINALIST_PAIRS = f"""
WITH p AS ({PRIORITY_ARGMAX})
SELECT season, a.wrestler_id % 2 AS bracket, a.wrestler_id AS winner_id, b.wrestler_id AS runner_up_id FROM p a JOIN p b USING (season)
WHERE a.wrestler_id % 2 = b.wrestler_id % 2 AND a.place LIKE '1st%' AND b.place LIKE '2nd%'
"""


def percent_rank_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.with_k(bouts(spark, sf_dir)).select("id", "bout_no", "k")


PERCENT_RANK_K = f"""
SELECT id, row_number() OVER (PARTITION BY season ORDER BY start, id) AS bout_no, round(24.0::DOUBLE * (1 + 0.5::DOUBLE * percent_rank() OVER (PARTITION BY season ORDER BY start))
  * CASE WHEN lower(coalesce(round, '')) LIKE '%final%' THEN 1.25::DOUBLE WHEN lower(coalesce(round, '')) LIKE '%semi%' THEN 1.15::DOUBLE WHEN lower(coalesce(round, '')) LIKE '%quarter%' THEN 1.1::DOUBLE
  WHEN lower(coalesce(round, '')) LIKE '%consol%' THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END, 3) AS k FROM ({BOUTS_SQL})
"""


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bouts(spark, sf_dir).where("outcome IN ('W', 'L') AND wrestler_id <> opponent_id").withColumn("won", F.when(F.col("outcome") == "W", 1).otherwise(0))
    return ratings.elo(ratings.with_k(df))


def elo_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).select("season", "bout_no", "id", "r_before", "o_before", "r_after", "o_after")


def elo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.composite(ratings.elo_summary(_rated(spark, sf_dir)), "last", "delta", "schedule", ["season"])


_K = "24.0::DOUBLE * (1 + 0.5::DOUBLE * percent_rank() OVER (PARTITION BY season ORDER BY start)) * CASE WHEN lower(coalesce(round, '')) LIKE '%final%' THEN 1.25::DOUBLE WHEN lower(coalesce(round, '')) LIKE '%semi%' THEN 1.15::DOUBLE WHEN lower(coalesce(round, '')) LIKE '%quarter%' THEN 1.1::DOUBLE WHEN lower(coalesce(round, '')) LIKE '%consol%' THEN 1.05::DOUBLE ELSE 1.0::DOUBLE END"
#: Each step of the recursion is a season's next bout, with the ratings of all its athletes as one list.
_FOLDED = f"""RECURSIVE b AS (SELECT season, id, wrestler_id + 1 AS w, opponent_id + 1 AS o, CASE outcome WHEN 'W' THEN 1 ELSE 0 END AS won, row_number() OVER (PARTITION BY season ORDER BY start, id) AS bout_no, round({_K}, 3) AS k
  FROM ({BOUTS_SQL}) WHERE outcome IN ('W', 'L') AND wrestler_id <> opponent_id),
f AS (SELECT season, 0::BIGINT AS bout_no, 0::BIGINT AS id, 0::BIGINT AS w, 0::BIGINT AS o, 0.0::DOUBLE AS r_before, 0.0::DOUBLE AS o_before, 0.0::DOUBLE AS r_after, 0.0::DOUBLE AS o_after, list_transform(range((SELECT greatest(max(w), max(o)) FROM b)), lambda x: 1500.0::DOUBLE) AS r FROM b GROUP BY season
  UNION ALL SELECT season, bout_no, id, w, o, r_before, o_before, r_after, o_after, list_concat(r[:least(w, o) - 1], [CASE WHEN w < o THEN r_after ELSE o_after END], r[least(w, o) + 1:greatest(w, o) - 1], [CASE WHEN w < o THEN o_after ELSE r_after END], r[greatest(w, o) + 1:])
  FROM (SELECT *, round(r_before + change, 3) AS r_after, round(o_before - change, 3) AS o_after FROM (SELECT b.season, b.bout_no, b.id, b.w, b.o, f.r, f.r[b.w] AS r_before, f.r[b.o] AS o_before, b.k * (b.won - 1 / (1 + pow(10, (f.r[b.o] - f.r[b.w]) / 400))) AS change FROM f JOIN b ON b.season = f.season AND b.bout_no = f.bout_no + 1)))"""
ELO_RATINGS = f"WITH {_FOLDED} SELECT season, bout_no, id, r_before, o_before, r_after, o_after FROM f WHERE bout_no > 0"
ELO_SUMMARY = f"""
WITH {_FOLDED}, s AS (SELECT season, bout_no, w - 1 AS wrestler_id, r_before AS before, r_after AS after, o_before AS other FROM f WHERE bout_no > 0 UNION ALL SELECT season, bout_no, o - 1, o_before, o_after, r_before FROM f WHERE bout_no > 0),
g AS (SELECT season, wrestler_id, count(*) AS bouts, arg_min(before, bout_no) AS first, arg_max(after, bout_no) AS last, round(sum(CAST(round(other * 1000) AS BIGINT)) / count(*) / 1000, 6) AS schedule, CASE WHEN count(*) > 1 THEN round(regr_slope(after, bout_no), 6) END AS slope FROM s GROUP BY ALL),
d AS (SELECT *, round(last - first, 3) AS delta FROM g),
z AS (SELECT *, avg(delta) OVER p AS da, stddev_pop(delta) OVER p AS ds, avg(schedule) OVER p AS sa, stddev_pop(schedule) OVER p AS ss FROM d WINDOW p AS (PARTITION BY season))
SELECT season, wrestler_id, bouts, first, last, schedule, slope, delta, round(0.7::DOUBLE * last + 0.2::DOUBLE * CASE WHEN ds > 0 THEN (delta - da) / ds ELSE 0 END + 0.1::DOUBLE * CASE WHEN ss > 0 THEN (schedule - sa) / ss ELSE 0 END, 6) AS score FROM z
"""
TOP_RATINGS = f"SELECT * FROM ({ELO_SUMMARY}) ORDER BY score DESC, season, wrestler_id LIMIT 25"


def top_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elo_summary(spark, sf_dir).orderBy(F.col("score").desc(), "season", "wrestler_id").limit(25)


def regr_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bouts(spark, sf_dir).join(read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "value"), "id")
    return df.groupBy("wrestler_id").agg(F.round(F.regr_slope("value", "match_order"), 4).alias("slope"))


REGR_SLOPE = f"SELECT wrestler_id, round(regr_slope(value, match_order), 4) AS slope FROM ({BOUTS_SQL}) JOIN events ON event_id = id GROUP BY wrestler_id"


def match_order_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bouts(spark, sf_dir).withColumn("match_order", F.when(F.col("id") % 4 != 0, F.col("match_order")))
    return records.backfill_order(df).select("id", "match_order")


MATCH_ORDER_BACKFILL = f"SELECT id, coalesce(CASE WHEN id % 4 <> 0 THEN match_order END, row_number() OVER (PARTITION BY wrestler_id ORDER BY id)) AS match_order FROM ({BOUTS_SQL})"


def soundex_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts have a name that sounds alike, for every part."""
    part = read(spark, sf_dir, "part").select("p_partkey", soundex_full("p_name").alias("sound"))
    return part.join(part.groupBy("sound").agg(F.count("*").alias("n")), "sound")


def _sound(c: str) -> str:
    letters = f"regexp_replace(upper({c}), '[^A-Z]', '', 'g')"
    codes = f"translate({letters}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"
    digits = f"list_reduce(list_prepend('', string_split(replace({codes}, '0', ''), '')), lambda a, c: CASE WHEN right(a, 1) = c THEN a ELSE a || c END)"
    code = f"{letters}[1:1] || CASE WHEN starts_with({codes}, '0') THEN {digits} ELSE substr({digits}, 2) END"
    return f"CASE WHEN {letters} = '' THEN '' ELSE rpad({code}, CAST(greatest(4, length({code})) AS INT), '0') END"


SOUNDEX_MATCH = f"WITH s AS (SELECT p_partkey, {_sound('p_name')} AS sound FROM part) SELECT p_partkey, sound, count(*) OVER (PARTITION BY sound) AS n FROM s"


def fuzzy_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts on both sides; but for one type the candidates' last words have other vowels, and schools differ in what follows."""
    part = read(spark, sf_dir, "part")
    names = part.select(F.col("p_partkey").alias("list_id"), F.col("p_name").alias("name"), F.concat("p_type", F.lit(", CO")).alias("school"))
    misspelt = F.concat(F.substring_index("p_name", " ", 1), F.lit(" "), F.translate(F.substring_index("p_name", " ", -1), "aeiou", "eioua"))
    candidate = F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(misspelt).alias("candidate")
    other = F.concat("p_type", F.when(F.col("p_size") > 25, " High").otherwise("")).alias("other")
    return matching.best_candidates(names, part.select(candidate, other)).withColumn("score", F.col("score").cast("long"))


def _normed(c: str) -> str:
    return rf"lower(trim(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')))"


FUZZY_BEST_MATCH = f"""
WITH r AS (SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN p_name ELSE split_part(p_name, ' ', 1) || ' ' || translate(split_part(p_name, ' ', -1), 'aeiou', 'eioua') END AS candidate,
  p_type || CASE WHEN p_size > 25 THEN ' High' ELSE '' END AS other FROM part),
rn AS (SELECT *, {_normed("candidate")} AS rname, {_normed("other")} AS rschool, {_sound(_normed("candidate"))} AS rsound FROM r),
n AS (SELECT DISTINCT p_name AS name, p_type || ', CO' AS school FROM part), ln AS (SELECT *, {_normed("name")} AS lname, {_normed("split_part(school, ',', 1)")} AS lschool, {_sound(_normed("name"))} AS lsound FROM n),
c AS (SELECT *, CAST(CAST(contains(rname, split_part(lname, ' ', 1)) AS INT) + CAST(contains(rname, split_part(lname, ' ', -1)) AS INT) + CAST(lsound = rsound AS INT) + CAST(contains(rschool, lschool) AS INT) + CAST(contains(lschool, rschool) AS INT) AS BIGINT) AS score
  FROM ln JOIN rn ON contains(rschool, lschool) OR contains(lschool, rschool) WHERE lsound = rsound OR contains(rname, split_part(lname, ' ', -1))),
k AS (SELECT *, row_number() OVER (PARTITION BY name, school ORDER BY score DESC, candidate, other) AS rank FROM c)
SELECT p_partkey AS list_id, name, candidate, score FROM part JOIN k ON p_name = name AND school = p_type || ', CO' WHERE rank = 1 AND score >= 4
"""


def bout_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bout_text(spark, sf_dir).select("id", parse.bout_index(F.col("raw_details")).alias("bout_index"))


BOUT_INDEX = rf"""
WITH {_LINES}, s AS (SELECT id, lower(trim(regexp_replace(l, '\s*\([^)]*\d[^)]*\)', '', 'g'))) AS t FROM x)
SELECT id, CASE WHEN t IS NOT NULL THEN list_reduce(list_prepend(CAST(0 AS BIGINT), [CAST(unicode(c) AS BIGINT) for c in string_split(t, '') if c <> '']), lambda h, c: (h * 31 + c) % 4294967296) END AS bout_index FROM s
"""


def parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.with_bout(bout_text(spark, sf_dir), strict=True).select("id", "me_before", "me_after", "is_bye", "is_exhibition", "is_tie", "is_unknown_forfeit", "is_forfeit", "is_varsity", "outcome", "counts_in_record")


PARSE_STRICT = rf"""
WITH {_LINES}, h AS (SELECT *, lower(l) AS w, lower(coalesce(wrestler_name, '')) AS me FROM x),
k AS (SELECT *, CASE WHEN strpos(w, ' over ') > 0 THEN strpos(w, ' over ') ELSE strpos(w, ' def.') END AS token FROM h),
s AS (SELECT *, CASE WHEN token > 0 THEN substr(w, 1, token - 1) END AS b, CASE WHEN token > 0 THEN substr(w, token) END AS a FROM k),
f AS (SELECT id, CASE WHEN contains(b, me) THEN 1 ELSE 0 END AS me_before, CASE WHEN contains(a, me) THEN 1 ELSE 0 END AS me_after,
  CASE WHEN regexp_matches(w, '\bbye\b') THEN 1 ELSE 0 END AS is_bye, CASE WHEN regexp_matches(w, '\bexhibition\b') THEN 1 ELSE 0 END AS is_exhibition,
  CASE WHEN regexp_matches(w, '\b(?:tie|draw)\b') THEN 1 ELSE 0 END AS is_tie, CASE WHEN regexp_matches(w, '\bover\s+unknown\s*\(\s*for\.\s*\)') THEN 1 ELSE 0 END AS is_unknown_forfeit,
  CASE WHEN regexp_matches(w, '\b(?:for\.|fft|forfeit)\b|\b(?:mff|med(?:ical)?\s*for(?:feit)?)\b|\b(?:inj\.?\s*def\.?|injury\s*default)\b|\b(?:dq|disqualification)\b') THEN 1 ELSE 0 END AS is_forfeit,
  CASE WHEN regexp_matches(w, '^varsity\b.* - ') THEN 1 ELSE 0 END AS is_varsity FROM s)
SELECT *, CASE WHEN is_bye = 1 THEN 'bye' WHEN is_exhibition = 1 THEN 'U' WHEN is_tie = 1 THEN 'T' WHEN is_unknown_forfeit = 1 THEN 'W'
  WHEN me_before > me_after THEN 'W' WHEN me_before < me_after THEN 'L' ELSE 'U' END AS outcome, 1 - greatest(is_bye, is_exhibition) AS counts_in_record FROM f
"""


QUERIES = {
    "running_record": (running_record, RUNNING_RECORD), "final_match_flags": (final_match_flags, FINAL_MATCH_FLAGS), "parse_round": (parse_round, PARSE_ROUND),
    "parse_result_score": (parse_result_score, PARSE_RESULT_SCORE), "parse_sides_outcome": (parse_sides_outcome, PARSE_SIDES_OUTCOME), "parse_names": (parse_names, PARSE_NAMES),
    "opponent_resolution": (opponent_resolution, OPPONENT_RESOLUTION), "winner": (winner, WINNER), "priority_argmax": (priority_argmax, PRIORITY_ARGMAX),
    "pair_head_to_head": (pair_head_to_head, PAIR_HEAD_TO_HEAD), "finalist_pairs": (finalist_pairs, FINALIST_PAIRS), "percent_rank_k": (percent_rank_k, PERCENT_RANK_K),
    "elo_ratings": (elo_ratings, ELO_RATINGS), "elo_summary": (elo_summary, ELO_SUMMARY), "top_ratings": (top_ratings, TOP_RATINGS), "regr_slope": (regr_slope, REGR_SLOPE),
    "bout_index": (bout_index, BOUT_INDEX), "parse_strict": (parse_strict, PARSE_STRICT),
    "match_order_backfill": (match_order_backfill, MATCH_ORDER_BACKFILL), "soundex_match": (soundex_match, SOUNDEX_MATCH), "fuzzy_best_match": (fuzzy_best_match, FUZZY_BEST_MATCH),
    "finalist_report": (finalist_report, FINALIST_REPORT),
}
