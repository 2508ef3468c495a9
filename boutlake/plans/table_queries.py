"""Queries over the driver's tables: enrichment, write protocols, reports, dates, pages and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boutlake.functions import compat, parse
from boutlake.operators import enrich, matching, ordered, ratings, reports, tasks, upsert
from boutlake.plans.adapters import read
from boutlake.sources import readers
from boutlake.streaming import refresh

NOW = "TIMESTAMP '2026-01-02 00:00:00'"
OLD = "TIMESTAMP '2026-01-01 00:00:00'"


def enrich_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ref = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    df = enrich.enrich_twice(line, ref, {"l_suppkey": "s_suppkey"}, {"l_partkey": "s_suppkey"}, ["s_name", "s_nationkey"], ("own_", "other_"), ["s_name"])
    return df.groupBy("own_s_nationkey", "other_s_nationkey").agg(F.count("*").alias("n"), F.count("other_s_name").alias("n_other"), F.min("own_s_name").alias("least_own"))


ENRICH_TWICE = """
SELECT a.s_nationkey AS own_s_nationkey, b.s_nationkey AS other_s_nationkey, count(*) AS n, count(b.s_name) AS n_other, min(a.s_name) AS least_own
FROM lineitem LEFT JOIN supplier a ON a.s_suppkey = l_suppkey LEFT JOIN supplier b ON b.s_suppkey = l_partkey GROUP BY ALL
"""


def backfill_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("team_name"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey")).alias("team_id"))
    ref = read(spark, sf_dir, "orders").where("o_orderpriority < '3'").groupBy(F.col("o_orderpriority").alias("team_name")).agg(F.max("o_custkey").alias("team_id"))
    return enrich.backfill(orders, ref, ["team_name"], "team_id").select("o_orderkey", "team_name", "team_id", "source")


BACKFILL_COALESCE = """
WITH d AS (SELECT o_orderkey, o_orderpriority AS team_name, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS given FROM orders),
r AS (SELECT o_orderpriority AS team_name, max(o_custkey) AS ref FROM orders WHERE o_orderpriority < '3' GROUP BY 1), s AS (SELECT team_name, min(given) AS self FROM d GROUP BY 1)
SELECT o_orderkey, team_name, coalesce(given, ref, self) AS team_id, CASE WHEN given IS NOT NULL THEN 'given' WHEN ref IS NOT NULL THEN 'reference' WHEN self IS NOT NULL THEN 'self' END AS source
FROM d LEFT JOIN r USING (team_name) LEFT JOIN s USING (team_name)
"""


def disjunctive_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(F.lit("s").alias("season"), F.lit("c").alias("category"), F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("team_id"), F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("team_name"))
    people = read(spark, sf_dir, "customer").select(F.lit("s").alias("season"), F.lit("c").alias("category"), F.col("c_custkey").alias("wrestler_id"), F.col("c_nationkey").cast("long").alias("team_id"), F.col("c_name").alias("team"))
    return enrich.athletes_with_events(events, people).select("wrestler_id", "team_id", "team")


DISJUNCTIVE_JOIN = """
WITH e AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN user_id END AS team_id, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS team_name FROM events)
SELECT DISTINCT c_custkey AS wrestler_id, CAST(c_nationkey AS BIGINT) AS team_id, c_name AS team FROM customer JOIN e ON c_nationkey = team_id OR (team_id IS NULL AND c_name = team_name)
"""


def theta_substring_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands with their type against words of names, brands and their first letters."""
    part = read(spark, sf_dir, "part").withColumn("label", F.concat("p_brand", F.lit(" "), "p_type"))
    words = part.select(F.explode(F.concat(F.split("p_name", " "), F.array(F.upper("p_brand"), F.substring("p_type", 1, 2), F.concat("label", F.lit("!"))))).alias("word"))
    return matching.theta_pairs(part, words, "label", "word")


THETA_SUBSTRING_JOIN = """
WITH t AS (SELECT DISTINCT p_brand || ' ' || p_type AS label FROM part),
w AS (SELECT DISTINCT unnest(list_concat(string_split(p_name, ' '), [upper(p_brand), substr(p_type, 1, 2), p_brand || ' ' || p_type || '!'])) AS word FROM part)
SELECT label, word FROM t JOIN w ON contains(lower(label), lower(word)) OR contains(lower(word), lower(label)) WHERE label <> '' AND word <> ''
"""


def _schools(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Schools of all parts, and their teams: for one type a team for each name, for another none."""
    part = read(spark, sf_dir, "part").withColumn("school", F.concat("p_brand", F.lit(" "), "p_type"))
    team = F.concat("school", F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit(" "), "p_name")).otherwise(""), F.lit(", CO"))
    return part.select("school").distinct(), part.where("p_type <> 'SMALL'").select(team.alias("team")).distinct()


_NORMED = r"lower(trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')))"
_SCHOOLS = f"""r AS (SELECT DISTINCT p_brand || ' ' || p_type AS school, {_NORMED.format("p_brand || ' ' || p_type")} AS sn FROM part),
l AS (SELECT *, {_NORMED.format("split_part(team, ',', 1)")} AS tn FROM (SELECT DISTINCT p_brand || ' ' || p_type || CASE WHEN p_type = 'ECONOMY' THEN ' ' || p_name ELSE '' END || ', CO' AS team FROM part WHERE p_type <> 'SMALL')),
g AS (SELECT school, coalesce(string_agg(DISTINCT team, ' , ' ORDER BY team), '') AS teams, count(DISTINCT team) AS n_teams FROM r LEFT JOIN l ON contains(tn, sn) OR contains(sn, tn) GROUP BY school)"""


def school_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.school_candidates(*_schools(spark, sf_dir))


SCHOOL_CANDIDATES = f"WITH {_SCHOOLS} SELECT * FROM g"


def school_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of manual pairs holds blanks, a pair that changes nothing and one name twice."""
    kind = F.col("p_type")
    manual = read(spark, sf_dir, "part").select(F.when(kind != "LARGE", F.concat("p_name", F.lit(", CO"))).alias("to_name"), F.concat(kind, F.lit(" Fr")).alias("from_name")).distinct()
    return matching.school_fixes(*_schools(spark, sf_dir), manual.unionByName(manual.select("from_name", "from_name").toDF("to_name", "from_name")))


SCHOOL_FIXES = f"""
WITH {_SCHOOLS}, m AS (SELECT min(p_name || ', CO') AS team, p_type || ' Fr' AS school FROM part WHERE p_type <> 'LARGE' GROUP BY p_type)
SELECT school AS from_name, split_part(teams, ',', 1) AS to_name FROM g WHERE n_teams = 1 AND teams <> school UNION ALL SELECT school, split_part(team, ',', 1) FROM m
"""


def anti_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "c_mktsegment")


ANTI_JOIN_MISSING = """
WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 200000)
SELECT c_mktsegment, count(*) AS n_reference, count(o_custkey) AS n_matched, count(*) - count(o_custkey) AS n_missing, round(100.0::DOUBLE * count(o_custkey) / count(*), 2) AS pct
FROM (SELECT DISTINCT c_mktsegment, c_custkey FROM customer) LEFT JOIN f ON o_custkey = c_custkey GROUP BY c_mktsegment
"""


def missing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def argmax_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return orders.join(last, ["o_custkey", "o_orderdate"])


def cross_join_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.lit(0.0).alias("zero"))
    return ratings.composite(df, "s_suppkey", "s_acctbal", "zero", ["s_nationkey"]).select("s_suppkey", "score")


CROSS_JOIN_ZSCORE = """
SELECT s_suppkey, round(0.7::DOUBLE * s_suppkey + 0.2::DOUBLE * CASE WHEN stddev_pop(s_acctbal) OVER w > 0 THEN (s_acctbal - avg(s_acctbal) OVER w) / stddev_pop(s_acctbal) OVER w ELSE 0.0 END, 6) AS score FROM supplier WINDOW w AS (PARTITION BY s_nationkey)
"""


def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rollup_counts(read(spark, sf_dir, "orders"), ["o_orderstatus"])


def rollup_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rollup_counts(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def conditional_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.conditional_counts(read(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "o_custkey")


CONDITIONAL_PIVOT = "SELECT o_orderpriority, " + ", ".join(f"count(DISTINCT CASE WHEN o_orderstatus = '{s}' THEN o_custkey END) AS n_{i}" for i, s in enumerate("FOP")) + " FROM orders GROUP BY 1"


def group_concat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("name"), F.concat(F.lit("T"), F.col("o_custkey") % 3).alias("team"), F.when(F.col("o_orderstatus") == "F", "2025").otherwise("2026").alias("season"), (F.col("o_orderkey") % 7).alias("wrestler_id"))
    return enrich.cross_season_summary(df, ("2025", "2026"))


GROUP_CONCAT_SUMMARY = """
WITH d AS (SELECT o_custkey % 50 AS name, concat('T', o_custkey % 3) AS team, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS s, o_orderkey % 7 AS w FROM orders)
SELECT name, string_agg(DISTINCT team, ',' ORDER BY team) AS teams, coalesce(string_agg(DISTINCT CAST(w AS VARCHAR), ',' ORDER BY CAST(w AS VARCHAR)) FILTER (WHERE s = 0), '') AS ids_0,
  coalesce(string_agg(DISTINCT CAST(w AS VARCHAR), ',' ORDER BY CAST(w AS VARCHAR)) FILTER (WHERE s = 1), '') AS ids_1,
  count(DISTINCT w) FILTER (WHERE s = 0) AS n_ids_0, count(DISTINCT w) FILTER (WHERE s = 1) AS n_ids_1,
  CAST(count(DISTINCT w) FILTER (WHERE s = 0) = 1 AND count(DISTINCT w) FILTER (WHERE s = 1) = 1 AS INT) AS one_to_one FROM d GROUP BY name
"""


def latest_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.latest_by_group(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", [F.col("o_orderdate"), -F.col("o_orderkey")])


LATEST_BY_GROUP = """
SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS nth FROM orders) WHERE nth = 1
"""


_EVENT = "CASE WHEN p_partkey % 3 = 0 THEN concat('CHSAA ', p_partkey % 7, CASE WHEN p_partkey % 2 = 0 THEN 'A Region ' ELSE 'a region ' END, p_size) ELSE p_name END"


def division_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all parts, and suppliers as teams; some have no event."""
    events = read(spark, sf_dir, "part").selectExpr("p_brand AS season", f"{_EVENT} AS event", "p_type AS team", "p_partkey % 60 AS team_id")
    teams = read(spark, sf_dir, "supplier").selectExpr("s_name AS team", "s_suppkey + 40 AS team_id")
    return enrich.regional_divisions(events, teams)


DIVISION_FROM_TEXT = f"""
WITH d AS (SELECT p_brand AS season, {_EVENT} AS event, p_type AS team, p_partkey % 60 AS team_id FROM part),
division AS (SELECT season, event, team, team_id, CASE WHEN event ILIKE '%1A%' THEN '1A' WHEN event ILIKE '%2A%' THEN '2A' WHEN event ILIKE '%3A%' THEN '3A' WHEN event ILIKE '%4A%' THEN '4A' WHEN event ILIKE '%5A%' THEN '5A' ELSE 'unknown' END AS team_division,
  trim(split_part(event, 'A', -1)) AS team_region FROM d WHERE event ILIKE '%CHSAA%' AND event ILIKE '%Region%' GROUP BY ALL HAVING right(team_division, 1) = 'A')
SELECT s_name AS team, s_suppkey + 40 AS team_id, CASE WHEN d.event IS NULL THEN 'no_regional_event' ELSE d.event END AS event, CASE WHEN d.event IS NULL THEN 'unknown' ELSE team_division END AS team_division,
  CASE WHEN d.event IS NULL THEN 'unknown' ELSE team_region END AS team_region FROM supplier LEFT JOIN division d ON d.team_id = s_suppkey + 40
"""


def window_over_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_custkey").alias("least"))
    return df.withColumn("n_low", F.sum(F.when(F.col("least") <= 3, F.col("n")).otherwise(0)).over(Window.partitionBy()))


WINDOW_OVER_AGG = "SELECT o_orderpriority, count(*) AS n, min(o_custkey) AS least, CAST(sum(CASE WHEN min(o_custkey) <= 3 THEN count(*) ELSE 0 END) OVER () AS BIGINT) AS n_low FROM orders GROUP BY 1"


def grand_total_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row of totals joined to all, where a window over no keys would gather the table in one task.
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(F.broadcast(orders.agg(F.count("*").alias("n_all"), F.count_if(F.col("o_orderstatus") == "F").alias("n_done"))), F.lit(True), "left")


GRAND_TOTAL_WINDOW = "SELECT o_orderkey, o_orderstatus, count(*) OVER () AS n_all, count(*) FILTER (WHERE o_orderstatus = 'F') OVER () AS n_done FROM orders"


def presence_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = reports.presence(read(spark, sf_dir, "events"), "user_id", {"first": F.dayofmonth("ts") % 2 == 0, "second": F.col("event_type") == "purchase"})
    return reports.overlap(flags, "first", "second")


PRESENCE_OVERLAP = """
WITH f AS (SELECT user_id, bool_or(day(ts) % 2 = 0) AS x, bool_or(event_type = 'purchase') AS y FROM events GROUP BY 1)
SELECT count(*) FILTER (WHERE x AND NOT y) AS first_only, count(*) FILTER (WHERE NOT x AND y) AS second_only, count(*) FILTER (WHERE x AND y) AS "both", count(*) FILTER (WHERE x OR y) AS either FROM f
"""


def dup_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


def logical_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.lower(F.trim(F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit(""))))
    return enrich.duplicate_keys(read(spark, sf_dir, "orders").select("o_custkey", c.alias("priority")), ["o_custkey", "priority"])


def union_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.census({n: read(spark, sf_dir, n) for n in CENSUS})


CENSUS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.union(b).distinct()


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; a fifth under keys that the source does not hold."""
    return read(spark, sf_dir, "customer").select(F.expr(_TARGET_KEY).alias("c_custkey"), "c_name", "c_acctbal", F.expr(OLD).alias("created_at"), F.expr(OLD).alias("updated_at"))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; a third under keys that the target does not hold."""
    name = F.when(F.col("c_custkey") % 7 == 0, "").when(F.col("c_custkey") % 11 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").select(F.expr(_SOURCE_KEY).alias("c_custkey"), name.alias("c_name"), F.when(F.col("c_custkey") % 13 != 0, F.col("c_acctbal")).alias("c_acctbal"))


_TARGET_KEY, _SOURCE_KEY = "CASE WHEN c_custkey % 5 = 0 THEN -1 - c_custkey ELSE c_custkey END", "CASE WHEN c_custkey % 3 = 0 THEN -1000000000 - c_custkey ELSE c_custkey END"
_SOURCE = f"SELECT {_SOURCE_KEY} AS c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN c_name || '!' ELSE c_name END AS c_name, CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS c_acctbal FROM customer"


def upsert_changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(_target(spark, sf_dir), _source(spark, sf_dir), ["c_custkey"], ["c_name", "c_acctbal"], F.expr(NOW), keep_good=["c_name"]).withColumns({c: F.col(c).cast("string") for c in ("created_at", "updated_at")})


UPSERT_CHANGED_ONLY = f"""
WITH t AS (SELECT {_TARGET_KEY} AS c_custkey, c_name, c_acctbal FROM customer), s AS ({_SOURCE}),
j AS (SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, t.c_custkey IS NOT NULL AS in_t, s.c_custkey IS NOT NULL AS in_s,
  CASE WHEN s.c_custkey IS NULL OR trim(coalesce(s.c_name, '')) = '' THEN t.c_name ELSE s.c_name END AS c_name, CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal, t.c_name AS tn, t.c_acctbal AS ta FROM t FULL JOIN s ON t.c_custkey = s.c_custkey),
a AS (SELECT *, CASE WHEN in_s AND NOT in_t THEN 'inserted' WHEN in_s AND (c_name IS DISTINCT FROM tn OR c_acctbal IS DISTINCT FROM ta) THEN 'updated' WHEN in_s THEN 'unchanged' ELSE 'kept' END AS action FROM j)
SELECT c_custkey, c_name, c_acctbal, CASE WHEN in_t THEN '2026-01-01 00:00:00' ELSE '2026-01-02 00:00:00' END AS created_at,
  CASE WHEN action IN ('inserted', 'updated') THEN '2026-01-02 00:00:00' ELSE '2026-01-01 00:00:00' END AS updated_at, action FROM a
"""


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.action_counts(upsert_changed_only(spark, sf_dir))


UPSERT_COUNTS = f"WITH u AS ({UPSERT_CHANGED_ONLY}) SELECT " + ", ".join(f"count(*) FILTER (WHERE action = '{a}') AS {a}" for a in ("inserted", "updated", "unchanged", "kept")) + " FROM u"


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders on both sides; keys of finished ones meet, those of others are shifted below zero."""
    df = read(spark, sf_dir, "orders")
    k = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-1 - F.col("o_custkey"))
    return df.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("o_orderkey")), df.select(k.alias("k"), "o_orderkey")


_KEYED = "t AS (SELECT o_custkey AS k, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1), s AS (SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 - o_custkey END AS k, o_orderkey FROM orders)"


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.insert_ignore(*_keyed(spark, sf_dir), ["k"], ["o_orderkey"])


def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.replace_by_key(*_keyed(spark, sf_dir), ["k"], ["o_orderkey"])


def replace_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("scope"))
    return upsert.replace_scope(df, df.where("(scope IS NULL OR scope = 'MACHINERY') AND c_custkey % 2 = 0").withColumn("c_custkey", -F.col("c_custkey")), ["scope"])


REPLACE_SCOPE = """
WITH d AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS scope FROM customer)
SELECT * FROM d WHERE scope IS NOT NULL AND scope <> 'MACHINERY' UNION ALL SELECT -c_custkey, scope FROM d WHERE (scope IS NULL OR scope = 'MACHINERY') AND c_custkey % 2 = 0
"""


def conditional_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return upsert.reset_where(df, (F.col("o_orderstatus") == "F") | (F.col("o_totalprice") < 50000), ["o_totalprice"])


def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.delete_where(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "O")


def mapping_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    patches = nation.where("n_nationkey < 5").select(F.col("n_name").alias("old"), F.concat(F.lit("New "), F.lower("n_name")).alias("new"))
    return upsert.patch_values(nation, "n_name", patches)


def keep_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.keep_last_groups(read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), ["event_type"], "user_id", "ts", 3).select("event_id", "user_id", "event_type")


KEEP_LAST_N = """
WITH g AS (SELECT event_type, user_id, max(ts) AS seen FROM events GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seen DESC, user_id DESC) AS nth FROM g)
SELECT event_id, user_id, event_type FROM events JOIN n USING (event_type, user_id) WHERE nth <= 3
"""


def most_recent_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.month("o_orderdate").alias("month"))
    return upsert.most_recent_flag(df, ["o_orderpriority"], "month", "is_latest")


def carry_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("division"))
    flags = read(spark, sf_dir, "orders").where("o_totalprice > 100000").select("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("division"))
    return enrich.carry_forward(people, flags.groupBy("o_custkey").agg(F.max("division").alias("division")), "c_custkey", "o_custkey", ["division"])


CARRY_FLAGS = """
WITH f AS (SELECT o_custkey, max(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END) AS division FROM orders WHERE o_totalprice > 100000 GROUP BY 1)
SELECT c_custkey, coalesce(f.division, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END) AS division FROM customer LEFT JOIN f ON o_custkey = c_custkey
"""

DATE_TEXT = """CASE o_orderkey % 6 WHEN 0 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) WHEN 1 THEN concat('12/05 - 12/', 6 + o_orderkey % 9, '/2025')
 WHEN 2 THEN concat('1/2/25 - 1/', 3 + o_orderkey % 9, '/26') WHEN 3 THEN '02/30/2025' WHEN 4 THEN concat('3/5-', 6 + o_orderkey % 9, '/2025') ELSE 'TBA' END"""


def date_range_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} AS text")
    start, end = compat.date_range(F.col("text"))
    return df.select("o_orderkey", start.cast("string").alias("start_date"), end.cast("string").alias("end_date"))


DATE_RANGE_PARSE = f"""
WITH d AS (SELECT o_orderkey, o_orderdate, {DATE_TEXT} AS t FROM orders)
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 1 THEN '2025-12-05' WHEN 2 THEN '2025-01-02' WHEN 4 THEN '2025-03-05' END AS start_date,
  CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) WHEN 1 THEN '2025-12-' || lpad(CAST(6 + o_orderkey % 9 AS VARCHAR), 2, '0')
  WHEN 2 THEN '2026-01-' || lpad(CAST(3 + o_orderkey % 9 AS VARCHAR), 2, '0') WHEN 4 THEN '2025-03-' || lpad(CAST(6 + o_orderkey % 9 AS VARCHAR), 2, '0') END AS end_date FROM d
"""


def mountain_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.date_format(compat.mountain(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("local"))


MOUNTAIN_TIME = "SELECT event_id, strftime(timezone('America/Denver', timezone('UTC', CAST(ts AS TIMESTAMP))), '%Y-%m-%d %H:%M:%S') AS local FROM events"


def day_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = read(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate")).alias("last"))
    days = span.select(F.explode(F.sequence(F.date_sub("last", 6), F.col("last"))).alias("day"))
    per = read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return days.join(per, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


DAY_SERIES = """
WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS last FROM orders), d AS (SELECT last - CAST(unnest(range(7)) AS INT) AS day FROM m)
SELECT CAST(day AS VARCHAR) AS day, count(o_orderkey) AS n FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day
"""


def url_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat("url", F.lit("?wrestlerId="), (F.col("page_id") * 3).cast("string"), F.lit("&season=2026#top"))
    return read(spark, sf_dir, "pages").select("page_id", compat.query_param(url, "wrestlerId").cast("long").alias("wrestler_id"), compat.query_param(url, "season").alias("season"), compat.query_param(url, "team").alias("team"))


URL_PARAM = "SELECT page_id, page_id * 3 AS wrestler_id, '2026' AS season, CAST(NULL AS VARCHAR) AS team FROM pages"


def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.transform(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))), lambda x: F.concat(F.lit("<tr><td> "), x["event_type"], F.lit("&nbsp; one</td><td><a href='/p?a=1&amp;wrestlerId="), x["event_id"], F.lit("'>x</a></td></tr>")))
    pages = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("page_id")).agg(F.concat(F.lit("<table>"), F.array_join(row, ""), F.lit("</table>")).alias("html"))
    rows = readers.grid_rows(pages)
    return rows.select("page_id", "row_index", F.get("cells", F.lit(0)).alias("kind"), compat.query_param(F.get("links", F.lit(0)), "wrestlerId").cast("long").alias("wrestler_id"))


HTML_ROWS = "SELECT user_id AS page_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS row_index, event_type || ' one' AS kind, event_id AS wrestler_id FROM events"


def team_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_team_count(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"])


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = "CASE event_id % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'LOCKED' WHEN 2 THEN 'DONE' ELSE 'FAILED' END"
    return read(spark, sf_dir, "events").selectExpr(
        "lpad(CAST(event_id AS STRING), 12, '0') AS task_id", "event_type AS scope", f"{status} AS status", "CAST(event_id % 5 AS INT) AS attempt_count",
        "CASE WHEN event_id % 4 = 1 THEN concat('w', event_id % 3) END AS locked_by", "CAST(CASE WHEN event_id % 4 = 1 THEN ts END AS TIMESTAMP) AS locked_at", "CAST(ts AS TIMESTAMP) AS updated_at",
    )


def queue_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.expr("TIMESTAMP '2024-01-15 00:00:00'")
    df = tasks.finish(_tasks(spark, sf_dir), "w1", F.substring("task_id", 12, 1) == "3", now)
    df = tasks.claim(tasks.reclaim(df, now), "w9", 50, now)
    return df.select("task_id", "status", "attempt_count", "locked_by")


QUEUE_TRANSITIONS = """
WITH t AS (SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS task_id, event_id % 4 AS q, event_id % 3 AS w, event_id % 10 AS z, CAST(event_id % 5 AS INT) AS attempt_count, ts FROM events),
f AS (SELECT *, CASE q WHEN 0 THEN 'PENDING' WHEN 2 THEN 'DONE' WHEN 3 THEN 'FAILED' ELSE CASE WHEN w <> 1 THEN 'LOCKED' WHEN z <> 3 THEN 'DONE' WHEN attempt_count >= 3 THEN 'FAILED' ELSE 'PENDING' END END AS s1 FROM t),
r AS (SELECT *, CASE WHEN s1 = 'LOCKED' AND ts < TIMESTAMP '2024-01-14 23:30:00' THEN 'PENDING' ELSE s1 END AS s2 FROM f),
c AS (SELECT task_id FROM r WHERE s2 = 'PENDING' AND attempt_count < 3 ORDER BY task_id LIMIT 50)
SELECT r.task_id, CASE WHEN c.task_id IS NOT NULL THEN 'LOCKED' ELSE s2 END AS status, CASE WHEN c.task_id IS NOT NULL THEN attempt_count + 1 ELSE attempt_count END AS attempt_count,
  CASE WHEN c.task_id IS NOT NULL THEN 'w9' WHEN s2 = 'LOCKED' THEN concat('w', w) END AS locked_by FROM r LEFT JOIN c ON c.task_id = r.task_id
"""


def queue_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.progress(_tasks(spark, sf_dir), "scope").drop("seconds")


QUEUE_PROGRESS = """
WITH t AS (SELECT event_type AS scope, count(*) AS n, count(*) FILTER (WHERE event_id % 4 = 0) AS pending, count(*) FILTER (WHERE event_id % 4 = 1) AS locked, count(*) FILTER (WHERE event_id % 4 = 2) AS done,
  count(*) FILTER (WHERE event_id % 4 = 3) AS failed, CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS s FROM events GROUP BY 1)
SELECT scope, n, pending, locked, done, failed, concat(CASE WHEN s // 3600 < 10 THEN '0' ELSE '' END, s // 3600, ':', lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(s % 60 AS VARCHAR), 2, '0')) AS duration FROM t
"""


def paged_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.page(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 30, 50)


def record_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "none").otherwise(F.concat(F.col("o_custkey") % 40, F.lit("-"), F.col("o_orderkey") % 9))
    df = read(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    wins, losses, pct = parse.parse_record(F.col("t"))
    return df.select("o_orderkey", wins.alias("wins"), losses.alias("losses"), pct.alias("pct"))


RECORD_TEXT = """
WITH d AS (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 40 END AS INT) AS wins, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 9 END AS INT) AS losses FROM orders)
SELECT *, CASE WHEN wins + losses > 0 THEN round(wins / (wins + losses), 3) END AS pct FROM d
"""


def list_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_type", F.lit(", "), "p_brand", F.lit(" (CO)"))).otherwise(F.concat(F.lit("Pat Van "), "p_brand", F.lit(" III")))
    first, last = parse.parse_list_name(F.col("name"))
    return part.select("p_partkey", name.alias("name")).select("p_partkey", first.alias("first_name"), last.alias("last_name"))


LIST_NAMES = "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'Pat' END AS first_name, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'Van ' || p_brand END AS last_name FROM part"


def name_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select("p_partkey", matching.common_prefix(F.col("p_name"), F.reverse(F.col("p_name"))).cast("long").alias("n"))


NAME_PREFIX = "SELECT p_partkey, CAST(list_max([i for i in range(0, length(p_name) + 1) if substr(p_name, 1, i) = substr(reverse(p_name), 1, i)]) AS BIGINT) AS n FROM part"


def custom_rank_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(2)
    rows = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), F.col("o_orderpriority").alias("x"))))
    df = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(rows.alias("rows"))
    return df.select("o_custkey", F.array_join(F.transform("rows", lambda r: r["x"]), ",").alias("priorities"))


CUSTOM_RANK_CONCAT = """
SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 1 ELSE 2 END, o_orderpriority) AS priorities FROM orders GROUP BY 1
"""


def seed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", tasks.task_id(F.lit("2026"), F.col("c_mktsegment"), F.col("c_custkey").cast("string")).alias("task_id"))


SEED_TASKS = "SELECT c_custkey, substr(sha1(concat_ws('|', '2026', c_mktsegment, CAST(c_custkey AS VARCHAR))), 1, 12) AS task_id FROM customer"


def optional_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {"o_orderstatus": "F", "o_orderpriority": None}
    tests = [F.col(c) == v for c, v in given.items() if v is not None]
    return readers.scan(spark, f"{sf_dir}/orders.parquet", *tests, F.col("o_totalprice") >= 100000).select("o_orderkey", "o_totalprice")


def events_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = refresh.events_per_window(df, "1 hour", "10 minutes")
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


EVENTS_WINDOWED = "SELECT strftime(time_bucket(INTERVAL 1 HOUR, CAST(ts AS TIMESTAMP)), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"


def list_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Athletes with an order yesterday, counted from the last day there is."""
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    last = orders.agg(F.date_sub(F.max("day"), 1).alias("day"))
    return read(spark, sf_dir, "customer").join(orders.join(F.broadcast(last), "day").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


LIST_REFRESH = "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) - 1 FROM orders))"



def alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as aliases of types: a type with several gives a row for each."""
    part = read(spark, sf_dir, "part")
    aliases = part.where("p_size <= 2").select(F.col("p_type").alias("team_raw"), F.col("p_brand").alias("team_canonical")).distinct()
    return enrich.with_aliases(part.select("p_partkey", F.when(F.col("p_size") <= 25, F.col("p_type")).otherwise(F.col("p_name")).alias("team")), aliases)


ALIAS_JOIN = """
WITH a AS (SELECT DISTINCT p_type AS team_raw, p_brand AS team_canonical FROM part WHERE p_size <= 2), w AS (SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_type ELSE p_name END AS team FROM part)
SELECT p_partkey, team, coalesce(team_canonical, team) AS team_canonical FROM w LEFT JOIN a ON team_raw = team
"""


def carry_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as bouts of two customers and two nations; some flags are null."""
    line = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("wrestler_id"), F.col("l_partkey").alias("opponent_id"), (F.col("l_suppkey") % 25).alias("team_id"), (F.col("l_partkey") % 30).alias("opponent_team_id"),
        F.col("l_returnflag").alias("qualifier"), F.lit("none").alias("opponent_qualifier"), F.col("l_linestatus").alias("division"), F.lit("none").alias("opponent_division"))
    athletes = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("wrestler_id"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("qualifier"))
    teams = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("division"))
    df = enrich.carry_everywhere(line, athletes, teams, ["qualifier"], ["division"])
    return df.groupBy("qualifier", "opponent_qualifier", "division", "opponent_division").agg(F.count("*").alias("n"))


CARRY_EVERYWHERE = """
WITH a AS (SELECT c_custkey AS id, nullif(c_mktsegment, 'BUILDING') AS q FROM customer)
SELECT coalesce(x.q, l_returnflag) AS qualifier, coalesce(y.q, 'none') AS opponent_qualifier, coalesce(s.n_name, l_linestatus) AS division, coalesce(t.n_name, 'none') AS opponent_division, count(*) AS n
FROM lineitem LEFT JOIN a x ON x.id = l_suppkey LEFT JOIN a y ON y.id = l_partkey LEFT JOIN nation s ON s.n_nationkey = l_suppkey % 25 LEFT JOIN nation t ON t.n_nationkey = l_partkey % 30 GROUP BY ALL
"""


def concat_by_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.concat_by(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


CONCAT_BY_OTHER = """
WITH o AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL)
SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY k, o_orderpriority) AS o_orderpriority FROM o GROUP BY o_custkey
"""


def _task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*(F.lit(s) for s in ("PENDING", "LOCKED", "DONE", "FAILED"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("task_set_id"), F.col("o_orderkey").cast("string").alias("task_id"), status.alias("status"), (F.col("o_orderkey") % 5).cast("int").alias("attempt_count"),
        F.when(status == "LOCKED", F.concat(F.lit("w"), F.col("o_custkey") % 3)).alias("locked_by"), F.expr(OLD).alias("locked_at"), F.expr(OLD).alias("updated_at"))


_TASK_TABLE = """t AS (SELECT o_orderpriority AS task_set_id, CAST(o_orderkey AS VARCHAR) AS task_id, ['PENDING', 'LOCKED', 'DONE', 'FAILED'][o_orderkey % 4 + 1] AS status, CAST(o_orderkey % 5 AS INT) AS attempt_count,
  CASE WHEN o_orderkey % 4 = 1 THEN concat('w', o_custkey % 3) END AS locked_by, '2026-01-01' AS day FROM orders)"""


def task_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.select_tasks(_task_table(spark, sf_dir), "2-HIGH", ["LOCKED"], "w1").select("task_id", "status", "locked_by")


TASK_SELECTION = f"WITH {_TASK_TABLE} SELECT task_id, status, locked_by FROM t WHERE task_set_id = '2-HIGH' AND status = 'LOCKED' AND locked_by = 'w1'"


def seed_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are tasks; finished ones are seeded into one set, which is open again; two sets stay."""
    seeds = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.lit("1-URGENT").alias("task_set_id"), F.col("o_orderkey").cast("string").alias("task_id"))
    df = tasks.prune_sets(tasks.seed(_task_table(spark, sf_dir), seeds, F.expr(NOW), reset=True), 2)
    return df.select("task_set_id", "task_id", "status", "attempt_count", "locked_by", F.to_date("updated_at").cast("string").alias("day"))


SEED_PROTOCOL = f"""
WITH {_TASK_TABLE}, s AS (SELECT task_id FROM t WHERE task_set_id = '1-URGENT' UNION SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'),
u AS (SELECT '1-URGENT' AS task_set_id, task_id, 'PENDING' AS status, 0 AS attempt_count, NULL AS locked_by, '2026-01-02' AS day FROM s UNION ALL SELECT * FROM t WHERE task_set_id <> '1-URGENT')
SELECT * FROM u WHERE task_set_id IN (SELECT task_set_id FROM (SELECT task_set_id, row_number() OVER (ORDER BY max(day) DESC, task_set_id DESC) AS n FROM u GROUP BY task_set_id) WHERE n <= 2)
"""


def generated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.with_ids(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 100)


QUERIES = {
    "enrich_twice": (enrich_twice, ENRICH_TWICE), "backfill_coalesce": (backfill_coalesce, BACKFILL_COALESCE), "disjunctive_join": (disjunctive_join, DISJUNCTIVE_JOIN),
    "theta_substring_join": (theta_substring_join, THETA_SUBSTRING_JOIN), "school_fixes": (school_fixes, SCHOOL_FIXES), "anti_join_missing": (anti_join_missing, ANTI_JOIN_MISSING),
    "missing_customers": (missing_customers, "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"),
    "argmax_final": (argmax_final, "SELECT o_custkey, o_orderdate, o_orderkey FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) USING (o_custkey, o_orderdate)"),
    "cross_join_zscore": (cross_join_zscore, CROSS_JOIN_ZSCORE),
    "rollup_counts": (rollup_counts, "SELECT o_orderstatus, count(*) AS n, CAST(grouping(o_orderstatus) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderstatus)"),
    "rollup_two_keys": (rollup_two_keys, "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "conditional_pivot": (conditional_pivot, CONDITIONAL_PIVOT), "group_concat_summary": (group_concat_summary, GROUP_CONCAT_SUMMARY), "latest_by_group": (latest_by_group, LATEST_BY_GROUP),
    "division_from_text": (division_from_text, DIVISION_FROM_TEXT), "window_over_agg": (window_over_agg, WINDOW_OVER_AGG),
    "grand_total_window": (grand_total_window, GRAND_TOTAL_WINDOW), "presence_overlap": (presence_overlap, PRESENCE_OVERLAP),
    "dup_key_check": (dup_key_check, "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "logical_duplicates": (logical_duplicates, "SELECT o_custkey, lower(trim(coalesce(nullif(o_orderpriority, '5-LOW'), ''))) AS priority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1"),
    "union_census": (union_census, " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in CENSUS)),
    "union_distinct": (union_distinct, "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier"),
    "upsert_changed_only": (upsert_changed_only, UPSERT_CHANGED_ONLY), "upsert_counts": (upsert_counts, UPSERT_COUNTS),
    "insert_ignore": (insert_ignore, f"WITH {_KEYED} SELECT * FROM t UNION ALL SELECT k, min(o_orderkey) FROM s WHERE k NOT IN (SELECT k FROM t) GROUP BY k"),
    "replace_by_key": (replace_by_key, f"WITH {_KEYED} SELECT * FROM t WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT k, min(o_orderkey) FROM s GROUP BY k"),
    "replace_scope": (replace_scope, REPLACE_SCOPE),
    "conditional_reset": (conditional_reset, "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' OR o_totalprice < 50000 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders"),
    "delete_rows": (delete_rows, "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O'"),
    "mapping_patch": (mapping_patch, "SELECT n_nationkey, CASE WHEN n_nationkey < 5 THEN 'New ' || lower(n_name) ELSE n_name END AS n_name FROM nation"),
    "keep_last_n": (keep_last_n, KEEP_LAST_N),
    "most_recent_flag": (most_recent_flag, "SELECT o_orderkey, o_orderpriority, CAST(month(o_orderdate) AS INT) AS month, CASE WHEN month(o_orderdate) = max(month(o_orderdate)) OVER (PARTITION BY o_orderpriority) THEN 1 ELSE 0 END AS is_latest FROM orders"),
    "carry_flags": (carry_flags, CARRY_FLAGS), "date_range_parse": (date_range_parse, DATE_RANGE_PARSE), "mountain_time": (mountain_time, MOUNTAIN_TIME), "day_series": (day_series, DAY_SERIES),
    "url_param": (url_param, URL_PARAM), "html_rows": (html_rows, HTML_ROWS), 
    "team_count": (team_count, "SELECT l_orderkey, l_linenumber, count(*) OVER w AS n_teams, CASE WHEN count(*) OVER w = 2 THEN 1 ELSE 0 END AS is_dual FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)"),
    "queue_transitions": (queue_transitions, QUEUE_TRANSITIONS), "queue_progress": (queue_progress, QUEUE_PROGRESS),
    "paged_export_order": (paged_export_order, "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 30"),
    "custom_rank_concat": (custom_rank_concat, CUSTOM_RANK_CONCAT), 
    "seed_tasks": (seed_tasks, SEED_TASKS),
    "optional_filters": (optional_filters, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000"),
    "events_windowed": (events_windowed, EVENTS_WINDOWED), "list_refresh": (list_refresh, LIST_REFRESH),
    "school_candidates": (school_candidates, SCHOOL_CANDIDATES), "alias_join": (alias_join, ALIAS_JOIN), "carry_everywhere": (carry_everywhere, CARRY_EVERYWHERE),
    "concat_by_other": (concat_by_other, CONCAT_BY_OTHER), "task_selection": (task_selection, TASK_SELECTION), "seed_protocol": (seed_protocol, SEED_PROTOCOL),
    "generated_ids": (generated_ids, "SELECT o_orderkey, o_custkey, 100 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id FROM orders"),
    "record_text": (record_text, RECORD_TEXT), "list_names": (list_names, LIST_NAMES), "name_prefix": (name_prefix, NAME_PREFIX),
}
