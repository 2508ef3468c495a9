"""Queries over stores and exports that hold the driver's tables, and over names by collation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlake.functions import compat
from boutlake.operators import enrich
from boutlake.plans.adapters import read
from boutlake.plans.table_queries import NOW, UPSERT_CHANGED_ONLY, _source, _target
from boutlake.sources import readers, writers
from boutlake.sources.export import export_csv, read_export
from boutlake.sources.shared import shared_path
from boutlake.sources.store import Store


def store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in buckets, merged with changed and new ones; the second merge of the same batch is left out."""
    store = Store.create(_target(spark, sf_dir), shared_path(spark, "customers"), ["c_custkey"], buckets=16)
    for _ in range(2):
        store.merge(_source(spark, sf_dir), ["c_name", "c_acctbal"], F.expr(NOW), ["c_name"], ("customers", 0))
    return store.read().withColumns({c: F.col(c).cast("string") for c in ("created_at", "updated_at")})


STORE_MERGE = f"SELECT * EXCLUDE (action) FROM ({UPSERT_CHANGED_ONLY})"

_MOVED = "CASE WHEN o_orderkey BETWEEN 1000 AND 1100 THEN -o_custkey ELSE o_custkey END"


def store_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in ranges, made equal to a source that differs in some of them."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    store = Store.create(orders, shared_path(spark, "orders"), ["o_orderkey"], part_rows=2000)
    store.sync(orders.withColumn("o_custkey", F.expr(_MOVED)), batch=4)
    return store.read()


STORE_SYNC = f"SELECT o_orderkey, {_MOVED} AS o_custkey, o_orderstatus, o_totalprice FROM orders"


def store_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty rows from the middle of the order of all lines, read from the ranges that hold them."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return Store.create(line, shared_path(spark, "lines"), keys, part_rows=4000).page(2345, 50)


STORE_PAGE = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem ORDER BY ALL LIMIT 50 OFFSET 2345"


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers exported in order, and read back by the manifest."""
    path = shared_path(spark, "customers-csv")
    df = read(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(' "x", '), "c_mktsegment").alias("label"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey")).alias("c_nationkey"))
    export_csv(df, path, ["c_custkey"], rows_per_file=500)
    return read_export(spark, path, "c_custkey long, label string, c_nationkey int")


CSV_ROUND_TRIP = """SELECT c_custkey, c_name || ' "x", ' || c_mktsegment AS label, CASE WHEN c_custkey % 5 > 0 THEN c_nationkey END AS c_nationkey FROM customer"""

#: The same name with marks composed or not, in capitals, in wide letters, with a stroke.
_SPELT = "CASE p_partkey % 5 WHEN 0 THEN concat('José Łuk ', p_name) WHEN 1 THEN concat('José  Luk ', upper(p_name)) WHEN 2 THEN concat('JOSE LUK ', p_name) WHEN 3 THEN concat('Ｊosé Łuk ', p_name) ELSE concat('Jose Lux ', p_name) END"


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts have each name, and how many brands, whatever their spelling."""
    part = read(spark, sf_dir, "part").select("p_brand", "p_partkey", F.lower("p_name").alias("p_name"))
    return part.withColumn("key", compat.name_key(F.expr(_SPELT))).groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands"), F.min("p_partkey").alias("least")).drop("key")


NAME_KEYS = """
SELECT count(*) AS n, count(DISTINCT p_brand) AS brands, min(p_partkey) AS least FROM (SELECT *, CASE WHEN p_partkey % 5 = 4 THEN 'lux ' ELSE 'luk ' END || lower(p_name) AS k FROM part) GROUP BY k
"""


def formatted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_timestamp("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", compat.number_text(F.col("o_totalprice"), 1).alias("price"), compat.date_text(day, "MM/DD/YYYY [at] hh:mm A").alias("at"),
        compat.date_text(day, "YY.M.D").alias("short"), compat.day_of_week(day).alias("weekday"))


FORMATTED_VALUES = """
SELECT o_orderkey, format('{:,.1f}', CAST(o_totalprice AS DOUBLE)) AS price, strftime(CAST(o_orderdate AS TIMESTAMP), '%m/%d/%Y at %I:%M %p') AS at,
  strftime(CAST(o_orderdate AS TIMESTAMP), '%y.') || month(o_orderdate) || '.' || day(o_orderdate) AS short, CAST(dayofweek(CAST(o_orderdate AS TIMESTAMP)) + 1 AS INT) AS weekday FROM orders
"""

def csv_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all customers written as CSV, blank ones among them, and read as a list; with the number of rows written."""
    path = shared_path(spark, "links")
    df = read(spark, sf_dir, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 9 = 0 THEN '  ' WHEN c_custkey % 7 > 0 THEN concat(' http://x/', c_name, '?a=\"', c_nationkey, '\" ') END AS name_link", "concat('a', chr(10), c_mktsegment) AS note")
    writers.write_csv(df, path)
    return readers.read_links(spark, path, "NAME_LINK").withColumn("n_rows", F.lit(readers.count_rows(spark, path)).cast("long"))


CSV_LINKS = """SELECT concat('http://x/', c_name, '?a="', c_nationkey, '"') AS NAME_LINK, (SELECT count(*) FROM customer) AS n_rows FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 7 > 0"""


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "orders-json")
    writers.write_json(read(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS status", "concat('é\"', o_orderpriority) AS label"), path)
    return spark.read.schema("o_orderkey long, status string, label string").json(path)


JSON_ROUND_TRIP = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS status, concat('é"', o_orderpriority) AS label FROM orders"""


def us_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as M/D/YYYY, days that no month has, and other text."""
    text = "CASE o_orderkey % 5 WHEN 0 THEN '2/30/2025' WHEN 1 THEN o_orderpriority WHEN 2 THEN NULL ELSE concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) END"
    return read(spark, sf_dir, "orders").select("o_orderkey", compat.us_date(F.expr(text)).cast("string").alias("day"))


US_DATES = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders"


def plain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "CASE p_partkey % 4 WHEN 0 THEN concat(' JOSÉ', chr(160), ' ', p_name) WHEN 1 THEN concat('Ñandú ', upper(p_name)) WHEN 2 THEN NULL ELSE concat('Ǻçé  ', p_name) END"
    return read(spark, sf_dir, "part").select("p_partkey", compat.norm_key(F.expr(name)).alias("plain"))


PLAIN_NAMES = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat('jose ', lower(p_name)) WHEN 1 THEN concat('nandu ', lower(p_name)) WHEN 2 THEN NULL ELSE concat('ace ', lower(p_name)) END AS plain FROM part"


def state_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of teams of one state with an event, by the team's id or by its name."""
    events = read(spark, sf_dir, "events").selectExpr("'s' AS season", "'c' AS category", "CASE WHEN event_id % 2 = 0 THEN user_id END AS team_id", f"{_TEAM_OF.format('user_id')} AS team_name")
    people = read(spark, sf_dir, "customer").selectExpr("'s' AS season", "'c' AS category", "c_custkey AS wrestler_id", "CAST(c_nationkey AS BIGINT) AS team_id", f"{_TEAM_OF.format('c_custkey')} AS team")
    return enrich.athletes_with_events(events, people, state="CO").select("wrestler_id", "team_id", "team")


_TEAM_OF = "concat('Team ', {0}, CASE WHEN {0} % 3 = 0 THEN ', WY' ELSE ', CO' END)"
STATE_SCAN = f"""
WITH e AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN user_id END AS team_id, {_TEAM_OF.format("user_id")} AS team_name FROM events WHERE user_id % 3 <> 0),
p AS (SELECT c_custkey AS wrestler_id, CAST(c_nationkey AS BIGINT) AS team_id, {_TEAM_OF.format("c_custkey")} AS team FROM customer)
SELECT DISTINCT p.* FROM p JOIN e ON e.team_id = p.team_id OR (e.team_id IS NULL AND e.team_name = p.team)
"""

QUERIES = {
    "store_merge": (store_merge, STORE_MERGE), "store_sync": (store_sync, STORE_SYNC), "store_page": (store_page, STORE_PAGE), "csv_round_trip": (csv_round_trip, CSV_ROUND_TRIP),
    "name_keys": (name_keys, NAME_KEYS), "formatted_values": (formatted_values, FORMATTED_VALUES),
    "csv_links": (csv_links, CSV_LINKS), "json_round_trip": (json_round_trip, JSON_ROUND_TRIP), "us_dates": (us_dates, US_DATES), "plain_names": (plain_names, PLAIN_NAMES), "state_scan": (state_scan, STATE_SCAN),
}
