"""Queries over the driver's tables: lists and schedules as pages, ranking documents, aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlake.operators import enrich, matching
from boutlake.operators.rankings import ranking_entries, with_latest_week
from boutlake.plans.adapters import read
from boutlake.plans.bout_queries import _sound
from boutlake.sources import pages, readers


def lag_lead_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.team_neighbours(read(spark, sf_dir, "part").select(F.col("p_name").alias("team")))


LAG_LEAD_ALIAS = """
WITH t AS (SELECT DISTINCT p_name AS team, trim(regexp_replace(lower(p_name), '[^0-9a-z ]', ' ', 'g')) AS team_clean FROM part),
n AS (SELECT *, lag(team_clean) OVER w AS before, lead(team_clean) OVER w AS after FROM t WINDOW w AS (ORDER BY team_clean, team))
SELECT *, CASE WHEN contains(before, split_part(team_clean, ' ', 1)) AND contains(before, split_part(team_clean, ' ', -1)) THEN 1 ELSE 0 END AS like_before,
  CASE WHEN contains(after, split_part(team_clean, ' ', 1)) AND contains(after, split_part(team_clean, ' ', -1)) THEN 1 ELSE 0 END AS like_after FROM n
"""

#: Names that are one word, share a first word or a start of it, or lose a word from one season to the next.
_TEAM = """CASE p_partkey % 4 WHEN 0 THEN concat(p_type, ' ', p_brand) WHEN 1 THEN concat(p_type, 'ern ', p_brand) WHEN 2 THEN concat(p_type, ' St. ', p_brand) ELSE concat(p_type, p_size % 5) END"""
_SEASON = "CASE WHEN p_partkey % 9 < 5 THEN '2025' ELSE '2026' END"


def alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.alias_pairs(read(spark, sf_dir, "part").selectExpr(f"{_SEASON} AS season", f"{_TEAM} AS team"), ("2025", "2026"))


ALIAS_PAIRS = f"""
WITH team_rollup AS (SELECT {_TEAM} AS team, max(CASE WHEN {_SEASON} = '2025' THEN 1 ELSE 0 END) AS has_2025, max(CASE WHEN {_SEASON} = '2026' THEN 1 ELSE 0 END) AS has_2026 FROM part GROUP BY 1),
words AS (SELECT *, trim(regexp_replace(lower(team), '[^0-9a-z ]', ' ', 'g')) AS c FROM team_rollup),
near AS (SELECT *, split_part(c, ' ', 1) AS word1, CASE WHEN contains(c, ' ') THEN split_part(c, ' ', -1) END AS word2, lag(c) OVER w AS pc, lead(c) OVER w AS nc, lag(team) OVER w AS pt, lead(team) OVER w AS nt,
  lag(has_2025) OVER w AS p5, lag(has_2026) OVER w AS p6, lead(has_2025) OVER w AS n5, lead(has_2026) OVER w AS n6 FROM words WINDOW w AS (ORDER BY c, team)),
scored AS (SELECT *, CASE WHEN pc IS NOT NULL AND ((word2 IS NULL AND contains(pc, word1)) OR (word2 IS NOT NULL AND contains(pc, word1) AND contains(pc, word2))) THEN 1 ELSE 0 END AS sp,
  CASE WHEN nc IS NOT NULL AND ((word2 IS NULL AND contains(nc, word1)) OR (word2 IS NOT NULL AND contains(nc, word1) AND contains(nc, word2))) THEN 1 ELSE 0 END AS sn FROM near)
SELECT DISTINCT team_raw, team_canonical FROM (SELECT coalesce(CASE WHEN has_2025 = 1 THEN team END, CASE WHEN sp = 1 AND p5 = 1 THEN pt END, CASE WHEN sn = 1 AND n5 = 1 THEN nt END) AS team_raw,
  coalesce(CASE WHEN has_2026 = 1 THEN team END, CASE WHEN sp = 1 AND p6 = 1 THEN pt END, CASE WHEN sn = 1 AND n6 = 1 THEN nt END) AS team_canonical FROM scored
  WHERE has_2025 + has_2026 = 1 AND ((sp = 1 AND coalesce(p5, 0) + coalesce(p6, 0) = 1 AND (has_2025 <> coalesce(p5, 0) OR has_2026 <> coalesce(p6, 0)))
    OR (sn = 1 AND coalesce(n5, 0) + coalesce(n6, 0) = 1 AND (has_2025 <> coalesce(n5, 0) OR has_2026 <> coalesce(n6, 0)))))
WHERE team_raw IS NOT NULL AND team_canonical IS NOT NULL
"""

#: A line of each kind that a ranking document may hold.
_LINE = """CASE p_partkey % 13 WHEN 0 THEN concat('Class-', p_size % 4 + 2, 'A') WHEN 1 THEN concat('Boys Class ', p_size % 5 + 1, 'a rankings') WHEN 2 THEN concat(100 + p_size, 'lbs')
  WHEN 3 THEN concat(p_size + 70, ' lbs - final') WHEN 4 THEN concat(p_size + 80, '') WHEN 5 THEN concat(p_size, '-', p_name, ', list') WHEN 6 THEN concat(p_size, '. ', p_name, ', ', p_type, ' (', p_size, ')')
  WHEN 7 THEN concat(p_name, ', ', p_type, ';') WHEN 8 THEN p_name WHEN 9 THEN concat('  ', p_name, ', ', p_brand, '(12-1), x') WHEN 10 THEN concat('2A Boys, ', p_name)
  WHEN 11 THEN concat(p_name, ' (a, b)') ELSE CASE WHEN p_size % 2 = 0 THEN '  ' END END"""
_DOCUMENT = f"p_brand AS source_file, CAST(substr(p_brand, 7, 1) AS INT) % 2 AS week, p_partkey AS line_no, {_LINE} AS line"


def ranking_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_latest_week(ranking_entries(read(spark, sf_dir, "part").selectExpr(*(x for x in [f"{_LINE} AS line", "p_brand AS source_file", "CAST(substr(p_brand, 7, 1) AS INT) % 2 AS week", "p_partkey AS line_no"]))))


RANKING_GRAMMAR = rf"""
WITH l AS (SELECT source_file, week, line_no, trim(line) AS line FROM (SELECT {_DOCUMENT} FROM part) WHERE trim(line) <> ''),
h AS (SELECT *, CASE WHEN week = 0 THEN CASE WHEN regexp_matches(line, '(?i)Class\s+\dA\b') THEN upper(regexp_extract(line, '(?i)Class\s+(\dA)\b', 1)) END
  WHEN regexp_matches(line, '(?i)^(Class[\s_-]*)?[2-5]A\b') THEN upper(regexp_extract(line, '(?i)^(?:Class[\s_-]*)?([2-5]A)\b', 1)) END AS header FROM l),
d AS (SELECT *, last_value(header IGNORE NULLS) OVER w AS division FROM h WINDOW w AS (PARTITION BY source_file ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, CASE WHEN header IS NULL AND division IS NOT NULL THEN CASE WHEN week = 0 THEN CASE WHEN regexp_matches(line, '(?i)^\d+\s*lbs?\b') THEN CAST(regexp_extract(line, '^\d+') AS INT) END
  WHEN NOT regexp_matches(line, '^\d\d?\s*[-.]') AND (regexp_matches(line, '(?i)^\d\d\d?\s*lbs?\b') OR regexp_matches(line, '^\d\d\d?$')) AND CAST(regexp_extract(line, '^\d+') AS INT) BETWEEN 90 AND 300 THEN CAST(regexp_extract(line, '^\d+') AS INT) END END AS w FROM d),
s AS (SELECT *, sum(CASE WHEN header IS NOT NULL OR w IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY source_file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM n),
e AS (SELECT *, max(w) OVER (PARTITION BY source_file, section) AS weight, regexp_replace(trim(split_part(line, '(', 1)), ';$', '') AS prefix FROM s),
p AS (SELECT *, CASE WHEN week = 0 THEN trim(split_part(prefix, ',', 1)) ELSE trim(regexp_replace(trim(split_part(prefix, ',', 1)), '^\d+\.\s*', '')) END AS name, trim(substr(prefix, strpos(prefix, ',') + 1)) AS school FROM e
  WHERE header IS NULL AND w IS NULL AND weight IS NOT NULL AND contains(line, ',') AND contains(prefix, ','))
SELECT source_file, week, division, weight, CAST(row_number() OVER (PARTITION BY source_file, section ORDER BY line_no) AS INT) AS rank, name, school, line, CASE WHEN week = max(week) OVER () THEN 1 ELSE 0 END AS is_most_recent_ranked_week
FROM p WHERE name <> '' AND school <> ''
"""


def latest_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as athletes, each twice; schools that only begin alike do not match."""
    part = read(spark, sf_dir, "part")
    athletes = part.selectExpr("p_partkey AS wrestler_id", "p_name AS name", "CASE WHEN p_partkey % 3 = 0 THEN concat(p_brand, ' High, CO') ELSE concat(lower(p_brand), ', CO') END AS team")
    ranks = part.selectExpr("upper(p_name) AS ranked_name", "CASE WHEN p_partkey % 7 = 0 THEN concat(p_brand, ' High') ELSE p_brand END AS ranked_school", "p_size AS rank", "100 + p_size AS weight", "p_partkey % 4 AS week", "CASE WHEN p_partkey % 5 > 0 THEN p_type END AS source_file")
    return matching.latest_rankings(athletes.unionAll(athletes), ranks)


LATEST_RANKING = """
WITH a AS (SELECT p_partkey AS wrestler_id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN concat(p_brand, ' High, CO') ELSE concat(lower(p_brand), ', CO') END AS team FROM part),
r AS (SELECT upper(p_name) AS ranked_name, CASE WHEN p_partkey % 7 = 0 THEN concat(p_brand, ' High') ELSE p_brand END AS ranked_school, p_size AS rank, 100 + p_size AS weight, p_partkey % 4 AS week, CASE WHEN p_partkey % 5 > 0 THEN p_type END AS source_file FROM part),
b AS (SELECT ranked_name, ranked_school, max(week) AS week, first(rank ORDER BY week DESC, rank) AS rank, first(weight ORDER BY week DESC, rank) AS weight,
  first(source_file ORDER BY week DESC, rank, source_file DESC) FILTER (WHERE source_file IS NOT NULL) AS source_file FROM r GROUP BY 1, 2)
SELECT wrestler_id, name, team, CASE WHEN ranked_name IS NULL THEN 0 ELSE 1 END AS is_name_match, CASE WHEN ranked_name IS NOT NULL THEN 1 END AS is_team_match, ranked_name, ranked_school, week, rank, weight, source_file
FROM (SELECT * FROM a UNION ALL SELECT * FROM a) LEFT JOIN b ON lower(ranked_name) = lower(name) AND lower(ranked_school) = lower(split_part(team, ',', 1))
"""


def name_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, other = matching.norm_name(F.concat("p_brand", F.lit(" "), "p_type")), matching.norm_name(F.expr("CASE WHEN p_partkey % 3 = 0 THEN concat(p_brand, ' ', p_name) WHEN p_partkey % 3 = 1 THEN concat(p_name, ' ', substr(p_type, 2)) ELSE concat(p_brand, '! ', p_type) END"))
    return read(spark, sf_dir, "part").select("p_partkey", matching.name_difference(name, other).alias("hint"), matching.last_name_overlap(name, other).alias("overlap"))


_NORM = r"lower(trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')))"
NAME_DIFFERENCE = f"""
WITH p AS (SELECT p_partkey, {_NORM.format("p_brand || ' ' || p_type")} AS a, {_NORM.format("CASE WHEN p_partkey % 3 = 0 THEN concat(p_brand, ' ', p_name) WHEN p_partkey % 3 = 1 THEN concat(p_name, ' ', substr(p_type, 2)) ELSE concat(p_brand, '! ', p_type) END")} AS b FROM part),
w AS (SELECT p_partkey, split_part(a, ' ', 1) AS a1, split_part(b, ' ', 1) AS b1, split_part(a, ' ', -1) AS a2, split_part(b, ' ', -1) AS b2 FROM p)
SELECT p_partkey, CASE WHEN a1 = b1 THEN 'first=OK' ELSE 'first:' || a1 || '→' || b1 END || ' | ' || CASE WHEN a2 = b2 THEN 'last=OK' ELSE 'last:' || a2 || '→' || b2 END AS hint,
  CAST(length(a2) - length(split_part(a2, b2, 1)) AS INT) AS overlap FROM w
"""

#: A page's rows, so that no page grows with the table.
_PAGE = 50
_PERSON = "CASE c_custkey % 4 WHEN 0 THEN concat(c_name, ', Pat Lee') WHEN 1 THEN concat('Pat&nbsp;  Lou Van ', c_name, ' Jr. ,') WHEN 2 THEN concat('Pat ', c_name, ' (Roman)') ELSE c_name END"
_RECORD = "CASE c_custkey % 3 WHEN 0 THEN concat(c_custkey % 40, '-', c_custkey % 7, ' (all)') WHEN 1 THEN '0 - 0' ELSE '' END"
_LIST_ROW = f"""concat('<tr class="dataGridRow"><td><div>', c_custkey, '</div></td><td><div>x</div></td><td><div><a href="https://w.example/p.jsp?a=1&amp;wrestlerId=', c_custkey, '">', {_PERSON}, '</a></div></td>',
  '<td><div><a href="/t?TEAMID=', c_nationkey, '">', c_mktsegment, ', CO</a></div></td><td><div>', 100 + c_nationkey, '</div></td><td><div> M </div></td><td><div>Jr.</div></td><td><div>Varsity</div></td><td><div>', {_RECORD}, '</div></td></tr>')"""


def athlete_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as rows of list pages of 50, and back."""
    rows = read(spark, sf_dir, "customer").selectExpr(f"c_custkey div {_PAGE} AS page_id", "c_custkey", f"{_LIST_ROW} AS row")
    made = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "row"))), lambda r: r["row"]), "\n").alias("rows"))
    return pages.athlete_rows(made.select("page_id", F.concat(F.lit("<table><tr><th>Name</th></tr>"), "rows", F.lit("</table>")).alias("html")))


ATHLETE_PAGES = f"""
WITH c AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 40 AS INT) WHEN c_custkey % 3 = 1 THEN 0 END AS wins, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 7 AS INT) WHEN c_custkey % 3 = 1 THEN 0 END AS losses FROM customer)
SELECT c_custkey // {_PAGE} AS page_id, CAST(row_number() OVER (PARTITION BY c_custkey // {_PAGE} ORDER BY c_custkey) AS INT) AS row_index, c_custkey AS wrestler_id, CAST(c_nationkey AS BIGINT) AS team_id,
  CASE WHEN c_custkey % 4 < 3 THEN 'Pat' END AS first_name, CASE WHEN c_custkey % 4 = 1 THEN 'Van ' || c_name ELSE c_name END AS last_name, replace({_PERSON}, '&nbsp;  ', ' ') AS name, c_mktsegment || ', CO' AS team,
  CAST(100 + c_nationkey AS VARCHAR) AS weight_class, 'M' AS gender, 'Jr.' AS grade, 'Varsity' AS level, nullif({_RECORD}, '') AS record_text, wins, losses, wins + losses AS matches,
  CAST(CASE WHEN wins + losses > 0 THEN round(wins / (wins + losses), 3) WHEN wins + losses = 0 THEN 0 END AS DECIMAL(5, 3)) AS win_pct,
  concat('https://w.example/p.jsp?a=1&wrestlerId=', c_custkey) AS name_link, concat('/t?TEAMID=', c_nationkey) AS team_link FROM c
"""

_NAME = """CASE o_orderkey % 6 WHEN 0 THEN concat('Team ', o_custkey, '@Club ', o_orderkey) WHEN 1 THEN concat('North, CO ', o_custkey % 60, ' South ', o_orderkey % 50) WHEN 2 THEN 'Winter Open' WHEN 3 THEN 'Winter Open'
  WHEN 4 THEN concat('Team', o_custkey % 90, ' South ', o_orderkey % 9) ELSE 'A @ B @ C' END"""
_JS = "CASE WHEN o_orderkey % 6 IN (2, 5) OR o_orderkey % 12 = 4 THEN concat('javascript:openEvent(', o_orderkey, ')') ELSE '' END"
_DATE = "CASE WHEN o_orderkey % 2 = 0 THEN '12/05 - 12/06/2025' ELSE concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate)) END"


def schedule_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as rows of schedule pages, their lines as teams of the events that open a list."""
    link = f"CASE WHEN {_JS} = '' THEN {_NAME} ELSE concat('<a href=\"', {_JS}, '\">', {_NAME}, '</a> +') END"
    row = f"concat('<tr class=\"', CASE WHEN o_orderkey % 4 = 0 THEN 'dataGridAltRow' ELSE 'dataGridRow' END, '\"><td>', o_orderkey, '</td><td> ', {_DATE}, '</td><td>', {link}, ' </td></tr>')"
    rows = read(spark, sf_dir, "orders").selectExpr(f"o_orderkey div {4 * _PAGE} AS page_id", "o_orderkey", f"{row} AS row")
    made = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "row"))), lambda r: r["row"]), "").alias("html"))
    team = F.concat(F.lit('<li><a target="_blank" href="/team?x=1&teamId='), "l_suppkey", F.lit('">Supplier  '), "l_suppkey", F.lit("</a><a href='/other'>x</a></li>"))
    lists = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", team.alias("li")))), lambda r: r["li"]), "").alias("html"))
    lists = lists.select(F.concat(F.lit("javascript:openEvent("), "l_orderkey", F.lit(")")).alias("event_js"), "html")
    teams = pages.schedule_teams(pages.schedule_rows(made))
    found = pages.classify_events(pages.expand_teams(teams, pages.event_teams(lists), ["page_id"]), ["page_id"])
    return found.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


SCHEDULE_PAGES = f"""
WITH o AS (SELECT o_orderkey // {4 * _PAGE} AS page_id, CAST(row_number() OVER (PARTITION BY o_orderkey // {4 * _PAGE} ORDER BY o_orderkey) AS INT) AS row_index, o_orderkey, o_custkey, o_orderkey % 6 AS kind, {_DATE} AS date_raw,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN DATE '2025-12-05' ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS start_date, CAST(CASE WHEN o_orderkey % 2 = 0 THEN DATE '2025-12-06' ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS end_date,
  {_NAME} AS event_name, {_JS} AS event_js FROM orders),
sides AS (SELECT *, unnest(CASE WHEN kind IN (2, 3) THEN [NULL] ELSE [1, 2] END) AS i FROM o),
t AS (SELECT *, CASE WHEN kind IN (2, 3) THEN event_name WHEN event_js <> '' THEN event_js WHEN kind = 0 THEN concat('Team ', o_custkey, ' @ Club ', o_orderkey) WHEN kind = 1 THEN 'North, CO @ South' ELSE 'Team @ South' END AS event_key,
  CASE kind WHEN 0 THEN CASE i WHEN 1 THEN concat('Team ', o_custkey) ELSE concat('Club ', o_orderkey) END WHEN 1 THEN CASE i WHEN 1 THEN 'North, CO' ELSE 'South' END
    WHEN 4 THEN CASE i WHEN 1 THEN 'Team' ELSE 'South' END WHEN 5 THEN CASE i WHEN 1 THEN 'A' ELSE 'B' END END AS name,
  CASE i WHEN 1 THEN 'away' WHEN 2 THEN 'home' END AS team_role, CASE kind WHEN 1 THEN CASE i WHEN 1 THEN o_custkey % 60 ELSE o_orderkey % 50 END WHEN 4 THEN CASE i WHEN 1 THEN o_custkey % 90 ELSE o_orderkey % 9 END END AS score FROM sides),
l AS (SELECT l_orderkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS INT) AS li, CAST(count(*) OVER (PARTITION BY l_orderkey) AS INT) AS ln FROM lineitem),
x AS (SELECT t.*, l_suppkey, li, ln FROM t LEFT JOIN l ON l_orderkey = o_orderkey AND event_js <> '' AND kind <> 5),
g AS (SELECT *, CAST(count(coalesce(li, i)) OVER (PARTITION BY page_id, event_key) AS INT) AS n FROM x)
SELECT page_id, row_index, date_raw, event_name, event_js, start_date, end_date, event_key, CASE WHEN li IS NULL THEN name ELSE concat('Supplier ', l_suppkey) END AS team_name_raw, team_role, CAST(coalesce(li, i) AS INT) AS team_index,
  CAST(score AS BIGINT) AS team_score, CASE WHEN li IS NOT NULL THEN ln WHEN kind IN (2, 3) THEN nullif(n, 0) ELSE 2 END AS event_team_count,
  CASE WHEN CASE WHEN li IS NOT NULL THEN ln WHEN kind IN (2, 3) THEN n ELSE 2 END = 2 THEN 'dual' ELSE 'tournament' END AS event_type, CASE WHEN li IS NOT NULL THEN CAST(l_suppkey AS BIGINT) END AS team_id FROM g
"""


def expand_event_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"concat(' ', {_NAME}, ' ') AS event_name", f"{_JS} AS event_js")
    return pages.schedule_teams(events).select("o_orderkey", "event_key", "team_name_raw", "team_role", "team_index", "team_score", "event_team_count", "event_type")


EXPAND_EVENT_TEAMS = SCHEDULE_PAGES.partition("),\nl AS")[0] + """)
SELECT o_orderkey, event_key, name AS team_name_raw, team_role, CAST(i AS INT) AS team_index, CAST(score AS BIGINT) AS team_score, CASE WHEN kind NOT IN (2, 3) THEN 2 END AS event_team_count,
  CASE WHEN kind IN (2, 3) THEN 'tournament' ELSE 'dual' END AS event_type FROM t
"""


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page."""
    return pages.lateral(read(spark, sf_dir, "pages").select("page_id", "html"), pages.page_links).select("page_id", "link_index", "href", "text")


PAGE_LINKS = """
WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS found FROM pages),
l AS (SELECT page_id, unnest(found) AS link, unnest(range(1, len(found) + 1)) AS i FROM a)
SELECT page_id, CAST(i AS INT) AS link_index, regexp_extract(link, 'href="([^"]*)"', 1) AS href, trim(regexp_extract(link, '>([^<]*)<', 1)) AS text FROM l
"""

def bout_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as rows of athletes' pages of one season each, and back."""
    row = """concat('<tr><td>', date_format(ts, 'MM/dd/yyyy'), '</td><td>Open&nbsp; ', event_type, '</td><td>120</td><td>Final - <a href="/p?wrestlerId=', user_id, '">Me</a> (N) over <a href="/p?x=1&amp;wrestlerId=', user_id * 7 + event_id, '">You</a></td></tr>')"""
    rows = read(spark, sf_dir, "events").selectExpr("user_id", "event_id div 200 AS page", "event_id", f"{row} AS row")
    made = rows.groupBy("user_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "row"))), lambda r: r["row"]), "").alias("rows"))
    made = made.select(F.col("user_id").alias("wrestler_id"), F.concat(F.lit("<tr><th>Date</th><th>Event</th><th>Weight</th><th>Result</th></tr><tr><td colspan=4>head</td></tr>"), "rows").alias("html"))
    return readers.bout_rows(made)


BOUT_PAGES = """
SELECT user_id AS wrestler_id, CAST(row_number() OVER (PARTITION BY user_id, event_id // 200 ORDER BY event_id) AS INT) AS match_order, strftime(ts, '%m/%d/%Y') AS date_raw, 'Open ' || event_type AS event, '120' AS weight_category,
  'Final - Me (N) over You' AS raw_details, CASE WHEN user_id * 7 + event_id <> user_id THEN user_id * 7 + event_id END AS opponent_id FROM events
"""


def carry_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as people, their orders as ids of two seasons; flags of the first for those with one id in each."""
    df = read(spark, sf_dir, "orders").selectExpr("o_custkey AS name", "'T' AS team", "CASE WHEN o_orderstatus = 'F' THEN '2025' ELSE '2026' END AS season", "o_orderkey % 4 AS wrestler_id", "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 > 0 THEN o_orderpriority END AS place")
    flags = df.groupBy("name").agg(F.max("place").alias("place"))
    return enrich.carried_flags(enrich.cross_season_summary(df, ("2025", "2026")).join(flags, "name"), ["name", "place"], ["place"])


CARRY_ONE_TO_ONE = """
WITH d AS (SELECT o_custkey AS name, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS s, o_orderkey % 4 AS w, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 > 0 THEN o_orderpriority END AS place FROM orders)
SELECT max(w) FILTER (WHERE s = 1) AS wrestler_id, name, max(place) AS place FROM d GROUP BY name HAVING count(DISTINCT w) FILTER (WHERE s = 0) = 1 AND count(DISTINCT w) FILTER (WHERE s = 1) = 1 AND max(place) IS NOT NULL
"""


def fuzzy_same_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As fuzzy_best_match, of candidates of the same weight alone."""
    part = read(spark, sf_dir, "part").withColumn("weight", F.expr("100 + p_size % 4"))
    names = part.select(F.col("p_partkey").alias("list_id"), F.col("p_name").alias("name"), F.concat("p_type", F.lit(", CO")).alias("school"), "weight")
    found = part.select(F.concat("p_name", F.lit("s")).alias("candidate"), F.expr("CASE WHEN p_size > 25 THEN concat(p_type, ' High') ELSE p_type END").alias("other"), "weight")
    return matching.best_candidates(names, found, same_weight=True).withColumn("score", F.col("score").cast("long"))


FUZZY_SAME_WEIGHT = f"""
WITH r AS (SELECT DISTINCT p_name || 's' AS candidate, CASE WHEN p_size > 25 THEN p_type || ' High' ELSE p_type END AS other, 100 + p_size % 4 AS weight FROM part),
rn AS (SELECT *, {_NORM.format("candidate")} AS rname, {_NORM.format("other")} AS rschool, {_sound(_NORM.format("candidate"))} AS rsound FROM r),
n AS (SELECT DISTINCT p_name AS name, p_type || ', CO' AS school, 100 + p_size % 4 AS weight FROM part), ln AS (SELECT *, {_NORM.format("name")} AS lname, {_NORM.format("split_part(school, ',', 1)")} AS lschool, {_sound(_NORM.format("name"))} AS lsound FROM n),
c AS (SELECT name, school, ln.weight, candidate, other, CAST(CAST(contains(rname, split_part(lname, ' ', 1)) AS INT) + CAST(contains(rname, split_part(lname, ' ', -1)) AS INT) + CAST(lsound = rsound AS INT) + CAST(contains(rschool, lschool) AS INT) + CAST(contains(lschool, rschool) AS INT) AS BIGINT) AS score
  FROM ln JOIN rn ON ln.weight = rn.weight AND (contains(rschool, lschool) OR contains(lschool, rschool)) WHERE lsound = rsound OR contains(rname, split_part(lname, ' ', -1))),
k AS (SELECT *, row_number() OVER (PARTITION BY name, school, weight ORDER BY score DESC, candidate, other) AS rank FROM c)
SELECT p_partkey AS list_id, name, candidate, score FROM part JOIN k ON p_name = name AND school = p_type || ', CO' AND weight = 100 + p_size % 4 WHERE rank = 1 AND score >= 4
"""

QUERIES = {
    "lag_lead_alias": (lag_lead_alias, LAG_LEAD_ALIAS), "alias_pairs": (alias_pairs, ALIAS_PAIRS), "ranking_grammar": (ranking_grammar, RANKING_GRAMMAR), "latest_ranking": (latest_ranking, LATEST_RANKING),
    "name_difference": (name_difference, NAME_DIFFERENCE), "athlete_pages": (athlete_pages, ATHLETE_PAGES), "schedule_pages": (schedule_pages, SCHEDULE_PAGES),
    "expand_event_teams": (expand_event_teams, EXPAND_EVENT_TEAMS), "page_links": (page_links, PAGE_LINKS),
    "bout_pages": (bout_pages, BOUT_PAGES), "carry_one_to_one": (carry_one_to_one, CARRY_ONE_TO_ONE), "fuzzy_same_weight": (fuzzy_same_weight, FUZZY_SAME_WEIGHT),
}
