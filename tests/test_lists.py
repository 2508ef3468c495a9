"""Orders in ranges, aliases, ranking documents, list and schedule pages."""

import io
import random
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from boutlake.operators import matching, ordered
from boutlake.operators.rankings import ranking_entries, week_of, with_latest_week
from boutlake.sources import pages, readers


@pytest.fixture(scope="module")
def keyed(spark):
    """Half of the rows share their first value, some of them null."""
    r = random.Random(4)
    rows = [(r.choice([None, 5, 5, 5, r.randrange(40)]), f"k{i:03}", i) for i in range(300)]
    return spark.createDataFrame(rows, "a int, b string, n int").repartition(6), sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def test_ranges_rise_with_the_order_and_cut_frequent_values(keyed):
    df, rows = keyed
    got = {r.n: r["__range"] for r in ordered.with_ranges(df, ["a", "b"], 20).collect()}
    ranges = [got[n] for _, _, n in rows]
    assert ranges == sorted(ranges) and len(set(ranges)) > 8
    assert max(ranges.count(x) for x in set(ranges)) < 80


def test_rows_are_placed_without_copies_of_the_cuts(spark):
    kind = "a double, b string, t timestamp, n int"
    keys = [(x, s, datetime(2026, 1, 1, 0, 0, 0, m)) for x in (None, -1.5, 0.0, 2.0, float("inf"), float("nan")) for s in (None, "", "a", "b") for m in (1, 7)]
    rows = [(*k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows[::-1], kind).repartition(3)
    for step in (1, 2, 5, 48):
        cuts = keys[::step]
        placed = ordered.range_of(df, ["a", "b", "t"], cuts)
        assert "Join" not in placed._jdf.queryExecution().optimizedPlan().toString()  # each row of a join would hold all cuts
        assert {r.n: r["__range"] for r in placed.collect()} == {i: i // step + 1 for i in range(len(keys))}
    assert {r["__range"] for r in ordered.range_of(df, ["a", "b", "t"], [(3.0, "", keys[0][2])]).where("a < 9").collect()} == {0}
    assert ordered.range_of(df, ["a"], [(0.0,), (0.0,), (2.0,)]).where("__range = 2").count() == 8


def test_neighbours_across_ranges(keyed):
    df, rows = keyed
    for each in (7, 50, 1000):
        got = {r.n: (r.p, r.q) for r in ordered.with_neighbours(df, ["a", "b"], {"n": ("p", "q")}, each).collect()}
        ns = [n for _, _, n in rows]
        assert got == {n: (p, q) for n, p, q in zip(ns, [None, *ns], [*ns[1:], None], strict=False)}


def test_ids_count_on_in_a_total_order(keyed):
    df, rows = keyed
    for each in (9, 1000):
        assert {r.n: r.id for r in ordered.with_ids(df, ["a", "b"], 100, each).collect()} == {n: 101 + i for i, (_, _, n) in enumerate(rows)}
    assert ordered.with_ids(df.where("n < 0"), ["a", "b"]).collect() == []


def test_team_neighbours(spark):
    teams = matching.team_neighbours(spark.createDataFrame([("Palmer H.S., CO",), ("Palmer High",), ("Palmer High School",), ("Zed",), ("Paz",), (None,)], "team string")).collect()
    assert {(r["team_clean"], r["before"], r["after"], r["like_before"], r["like_after"]) for r in teams} == {
        ("palmer h s   co", None, "palmer high", 0, 0), ("palmer high", "palmer h s   co", "palmer high school", 0, 1), ("palmer high school", "palmer high", "paz", 0, 0),
        ("paz", "palmer high school", "zed", 0, 0), ("zed", "paz", None, 0, 0)}


def aliases(spark, old, new, both=()):
    rows = [("a", x) for x in (*old, *both)] + [("b", x) for x in (*new, *both)]
    return {tuple(r) for r in matching.alias_pairs(spark.createDataFrame(rows, "season string, team string"), ("a", "b")).collect()}


def test_aliases_hold_first_and_last_word(spark):
    assert aliases(spark, ["North Platte"], ["North Park"]) == set()
    assert aliases(spark, ["East St Mary"], ["Eastern Saint Mary"]) == {("East St Mary", "Eastern Saint Mary")}
    assert aliases(spark, ["Palmer High"], ["Palmer"]) == {("Palmer High", "Palmer")}
    assert aliases(spark, ["Eastern Saint Mary"], ["East St Mary"]) == {("Eastern Saint Mary", "East St Mary")}


def test_aliases_are_neighbours_of_one_season_each(spark):
    assert aliases(spark, ["Alpha High"], ["Alpha"], ["Alpha B"]) == set()  # another name stands between them
    assert aliases(spark, ["Alpha High", "Alpha"], []) == set()
    assert aliases(spark, ["Zeta"], ["Zeta One"], ["Alpha"]) == {("Zeta", "Zeta One")}
    # "Beta B" is like the one before, of both seasons, and the one after, of the other; the one before gives the name.
    assert aliases(spark, ["Beta Gamma Beta"], ["Beta B"], ["Beta"]) == {("Beta", "Beta B"), ("Beta Gamma Beta", "Beta B")}


def entries(spark, lines, week):
    rows = [("d", week, i, x) for i, x in enumerate(lines)]
    got = ranking_entries(spark.createDataFrame(rows, "source_file string, week int, line_no int, line string"))
    return [(r.division, r.weight, r.rank, r.name, r.school) for r in sorted(got.collect(), key=lambda r: (r.division, r.weight, r["rank"]))]


def test_later_rankings(spark):
    lines = ["Class-4A", "106lbs", "1. Ann Lee, North (12)", "Updated weekly by staff", "2A Boys", "106 lbs - final", "Bo Ray, South"]
    assert entries(spark, lines, 1) == [("2A", 106, 1, "Bo Ray", "South"), ("4A", 106, 1, "Ann Lee", "North")]
    lines = ["106", "Too Early, North", "3A", "Still, No Weight", "15-Crowley, County", "50lbs", "113", "2. Cy, East;", "(odd, note)", "Di, ", "  3.Ed Fox , West, KS; ", "301", None, "", "120lbs.", "Flo, Far"]
    assert entries(spark, lines, 3) == [("3A", 113, 1, "Cy", "East"), ("3A", 113, 2, "Ed Fox", "West, KS"), ("3A", 120, 1, "Flo", "Far")]


def test_first_rankings(spark):
    lines = ["Top of Class 4a boys", "15 lbs", "1. Ann Lee, North", "4A", "Cy, East; (old)", "Class 9A", "Bo, South", "106lb", "Di, West"]
    assert entries(spark, lines, 0) == [("4A", 15, 1, "1. Ann Lee", "North"), ("4A", 15, 2, "Cy", "East"), ("9A", 106, 1, "Di", "West")]
    assert entries(spark, lines, None) == entries(spark, lines, 0)


def test_ranking_documents(spark, tmp_path):
    lines = ["Class 4A", "120", "1. Ann Lee, North", "2. Bo Ray,<w:tab/>South;", "Cy", "Class 5A", "126 lbs", "Fay Oh, West"]
    run = lambda x: "".join(f"<w:t>{p}</w:t>" if p != "<w:tab/>" else p for p in x.replace("<w:tab/>", "|<w:tab/>|").split("|"))
    body = "".join(f'<w:p><w:pPr><w:tabs><w:tab w:val="left"/></w:tabs></w:pPr><w:r>{run(x)}</w:r></w:p>' for x in lines)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="urn:w"><w:body>{body}</w:body></w:document>')
    for name in ("rankings week 1.docx", "week_12_boys.docx", "notes.docx"):
        (tmp_path / name).write_bytes(data.getvalue())
    got = with_latest_week(readers.read_rankings(spark, str(tmp_path)))
    wanted = [("4A", 120, 1, "Ann Lee", "North"), ("4A", 120, 2, "Bo Ray", "South"), ("5A", 126, 1, "Fay Oh", "West")]
    assert sorted((r.week, r.is_most_recent_ranked_week, r.division, r.weight, r["rank"], r.name, r.school) for r in got.collect()) == [(w, f, *x) for w, f in ((1, 0), (12, 1)) for x in wanted]


def test_week_of_a_file(spark):
    w = lambda x: spark.range(1).select(week_of(F.lit(x))).first()[0]
    assert [w(x) for x in ("week_0_high_school", "Week-3.docx", "week 12", "week_4b", "notes", "week")] == [0, 3, 12, None, None, None]


def test_latest_rankings_keep_equal_rows(spark):
    people = spark.createDataFrame([("Ann Lee", "North, CO")] * 2 + [("Ann Lee", "North High, CO"), ("ann lee", "NORTH"), (None, None), ("Bo", None)], "name string, team string")
    ranks = spark.createDataFrame([("Ann Lee", "North", 1, 4, 106, "w1"), ("ANN LEE", "North", 2, 7, 113, None), ("Ann Lee", "North", 2, 9, 120, "w2b"), ("Cy", "North", 3, 1, 106, "w3")], "ranked_name string, ranked_school string, week int, rank int, weight int, source_file string")
    got = [(r.name, r.team, r.is_name_match, r.is_team_match, r.week, r["rank"], r.weight, r.source_file) for r in matching.latest_rankings(people, ranks).collect()]
    hit, miss = (1, 1, 2, 7, 113, "w2b"), (0, None, None, None, None, None)
    assert sorted(got, key=str) == sorted([("Ann Lee", "North, CO", *hit)] * 2 + [("ann lee", "NORTH", *hit), ("Ann Lee", "North High, CO", *miss), (None, None, *miss), ("Bo", None, *miss)], key=str)


def test_name_hints(spark):
    h = lambda a, b: tuple(spark.range(1).select(matching.name_difference(F.lit(a), F.lit(b)), matching.last_name_overlap(F.lit(a), F.lit(b))).first())
    assert h("ann lee", "ann lee") == ("first=OK | last=OK", 3)
    assert h("ann leeson", "anne son") == ("first:ann→anne | last:leeson→son", 3)
    assert h("ann lee", "bo ray") == ("first:ann→bo | last:lee→ray", 0)


LIST = """<table><tr class="header"><td><div>Name</div></td></tr>
<tr class="dataGridRow odd"><td><div>1</div></td><td><div><input></div></td><td><div><a href="https://x.example/p.jsp?b=2&amp;wrestlerId=77&amp;c=1">Van&nbsp;  Dyk, Ann Marie </a></div></td>
<td><div><a href="/team?ORGID=9">North, CO</a> <a href="/other?teamId=4">x</a></div></td><td><div>106</div><td><div>F</div></td><td><div>Sr.</div></td><td><div>Varsity</div></td><td><div> 12 - 3 (all)</div></td></tr>
<tr class="dataGridAltRow"><td><div>2</div></td></tr>
<tr class="dataGridRow"><td><div>3</div></td><td><div></div></td><td><div>Boyd Van Der Berg Jr. ,</div></td></tr></table>"""


def test_athlete_rows(spark):
    got = pages.athlete_rows(spark.createDataFrame([(1, LIST, "u"), (2, None, "v"), (3, "<tr><td>", "w")], "page_id int, html string, page_url string")).orderBy("page_id", "row_index").collect()
    a, b = got
    assert (a.page_id, a.page_url, a.row_index, a.wrestler_id, a.team_id, a.first_name, a.last_name, a.name, a.team) == (1, "u", 1, 77, 9, "Ann", "Van Dyk", "Van Dyk, Ann Marie", "North, CO x")
    assert (a.weight_class, a.gender, a.grade, a.level, a.record_text, a.wins, a.losses, a.matches, float(a.win_pct)) == ("106", "F", "Sr.", "Varsity", "12 - 3 (all)", 12, 3, 15, 0.8)
    assert (b.row_index, b.wrestler_id, b.name_link, b.first_name, b.last_name, b.team, b.record_text, b.win_pct) == (2, None, None, "Boyd", "Der Berg", "", None, None)


def test_names_and_ids_of_lists(spark):
    names = ["Lee, Ann Marie", "Ann Lee", "Ann Lou Lee", "Lee", "Bo De La Cruz", "Bo la Cruz", "Ann Lee III", "Boyd Thomas (Roman)", "Ann Lee, Jr.", "", " , ", None, "Lee,"]
    first, last = pages.page_name(F.col("n"))
    got = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", first.alias("f"), last.alias("l")).orderBy("i").collect()
    assert [(r.f, r.l) for r in got] == [("Ann", "Lee"), ("Ann", "Lee"), ("Ann", "Lee"), (None, "Lee"), ("Bo", "La Cruz"), ("Bo", "la Cruz"), ("Ann", "Lee"), ("Boyd", "Thomas"), ("Ann", "Lee"), (None, None), (None, None), (None, None), (None, "Lee")]
    links = ["/p?teamId=5", "/p?a=1&clubId=7#x", "/p?TEAMID=8&b", "/p?teamId=x&orgId=3", "/p", None, "/p?xteamId=4", "/p?orgId=2&teamId=6"]
    got = spark.createDataFrame([(i, n) for i, n in enumerate(links)], "i int, n string").select("i", pages.link_number(F.col("n"), pages.TEAM_IDS).alias("k")).orderBy("i").collect()
    assert [r.k for r in got] == [5, 7, 8, 3, None, None, None, 6]


SCHEDULE = """<table class="dataGrid"><tr class="dataGridRow"><td>1</td><td> 12/05 - 12/06/2025 </td><td><a href="javascript:openEvent(1)">Winter Open</a> <a href="/x">more</a></td></tr>
<tr class="dataGridAltRow"><td>2</td><td></td><td></td></tr>
<tr class="dataGridRow"><td>3</td><td>1/9/2026</td><td>North@South </td></tr>
<tr class="dataGridRow"><td>4</td><td>1/10/2026</td><td>Team16 South 3 </td></tr>
<tr class="other"><td>5</td><td>1/10/2026</td><td>Not a row</td></tr><tr class="dataGridRow"><td>6</td><td>short</td></tr>
<tr class="dataGridRow"><td>7</td><td>1/11/2026</td><td>Spring Open</td></tr></table>"""
POPUP = '<div><a target="_blank" href="/t?teamId=8">East  High</a><a href="/t?teamId=9">not this</a><a target="_blank" href="/t?TeamId=9">nor this</a><a target="_blank" href="/t?x=1&teamId=">West</a></div>'


def test_schedule_rows_and_their_teams(spark):
    rows = pages.schedule_rows(spark.createDataFrame([(1, SCHEDULE), (2, None)], "page_id int, html string"))
    assert [(r.row_index, r.event_name, r.event_js, str(r.start_date), str(r.end_date)) for r in rows.orderBy("row_index").collect()] == [
        (1, "Winter Open", "javascript:openEvent(1)", "2025-12-05", "2025-12-06"), (3, "North@South", "", "2026-01-09", "2026-01-09"), (4, "Team16 South 3", "", "2026-01-10", "2026-01-10"), (5, "Spring Open", "", "2026-01-11", "2026-01-11")]
    lists = pages.event_teams(spark.createDataFrame([("javascript:openEvent(1)", POPUP), ("javascript:openEvent(2)", "")], "event_js string, html string"))
    got = pages.classify_events(pages.expand_teams(pages.schedule_teams(rows), lists), ["page_id"])
    found = sorted(((r.row_index, r.team_index or 0, r.event_key, r.team_name_raw, r.team_role, r.team_score, r.team_id, r.event_team_count, r.event_type) for r in got.collect()), key=lambda x: x[:2])
    assert found == [
        (1, 1, "Winter Open", "East High", None, None, 8, 2, "dual"), (1, 2, "Winter Open", "West", None, None, None, 2, "dual"),
        (3, 1, "North @ South", "North", "away", None, None, 2, "dual"), (3, 2, "North @ South", "South", "home", None, None, 2, "dual"),
        (4, 1, "Team @ South", "Team", "away", 16, None, 2, "dual"), (4, 2, "Team @ South", "South", "home", 3, None, 2, "dual"), (5, 0, "Spring Open", None, None, None, None, None, "tournament")]


def test_events_of_one_name_on_a_page_are_counted_together(spark):
    rows = spark.createDataFrame([(1, "Open", "", "Open", i, n, k) for i, n, k in [(1, None, None), (None, None, None)]] + [(2, "Open", "", "Open", None, None, None)], "page_id int, event_name string, event_js string, event_key string, team_index int, event_team_count int, event_type string")
    got = pages.classify_events(rows, ["page_id"]).select("page_id", "event_team_count", "event_type").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 1, "tournament")] * 2 + [(2, None, "tournament")]))
