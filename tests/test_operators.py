import io
import random
import zipfile
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from boutlake.operators import enrich, matching, ratings, reports, tasks, upsert
from boutlake.operators.groups import connected_groups
from boutlake.sources import readers, writers
from boutlake.streaming import refresh

T = "k int, v string, created_at string, updated_at string"


def test_upsert_is_idempotent_and_null_safe(spark):
    target = spark.createDataFrame([(1, "a", "o", "o"), (2, None, "o", "o"), (None, "n", "o", "o")], T)
    source = spark.createDataFrame([(1, "b"), (1, "c"), (2, None), (3, ""), (None, "n")], "k int, v string")
    once = upsert.upsert(target, source, ["k"], ["v"], F.lit("n"))
    assert sorted(map(str, (tuple(r) for r in once.collect()))) == sorted(map(str, [(1, "b", "o", "n", "updated"), (2, None, "o", "o", "unchanged"), (3, "", "n", "n", "inserted"), (None, "n", "o", "o", "unchanged")]))
    again = upsert.upsert(once.drop("action"), source, ["k"], ["v"], F.lit("later"))
    assert {r["action"] for r in again.collect()} == {"unchanged"}
    kept = upsert.upsert(target, source, ["k"], ["v"], F.lit("n"), keep_good=["v"])
    assert {r["k"]: r["v"] for r in kept.collect()}[2] is None
    assert tuple(upsert.action_counts(once).first()) == (1, 1, 2, 0)


def test_write_protocols(spark):
    t = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    s = spark.createDataFrame([(None, "n"), (3, "b"), (3, "a")], "k int, v string")
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    assert rows(upsert.replace_scope(t, s, ["k"])) == sorted(map(str, [(1, "x"), (2, "y"), (None, "n"), (3, "b"), (3, "a")]))
    assert rows(upsert.insert_ignore(t, s, ["k"], ["v"])) == sorted(map(str, [(1, "x"), (2, "y"), (None, "z"), (3, "a")]))
    assert rows(upsert.reset_where(t, F.col("k") > 1, ["v"])) == sorted(map(str, [(1, "x"), (2, None), (None, "z")]))
    assert rows(upsert.delete_where(t, F.col("k") > 1)) == sorted(map(str, [(1, "x"), (None, "z")]))
    assert upsert.ensure_columns(t, {"v": "string", "w": "int"}).columns == ["k", "v", "w"]


def test_enrichment_keeps_rows(spark):
    fact = spark.createDataFrame([(1, 9), (1, None), (7, 1)], "a int, b int")
    ref = spark.createDataFrame([(1, "p"), (1, "q"), (9, "r"), (None, "s")], "id int, d string")
    got = enrich.enrich_twice(fact, ref, {"a": "id"}, {"b": "id"}, ["d"], ("own_", "opp_"), ["d"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, 9, "p", "r"), (1, None, "p", None), (7, 1, None, "p")]))


def test_placements(spark):
    p = lambda s, r, o: spark.range(1).select(enrich.placement(F.lit(s), F.lit(r), F.lit(o), {"2024-25": "2025"})).first()[0]
    rounds = [("1st Place Match", "W"), ("1st Place Match", "L"), ("5th Place Match", "L"), ("3rd Place Match", "T"), ("Final", "W"), (None, "W")]
    assert [p("2024-25", r, o) for r, o in rounds] == ["1st_state_place_2025", "2nd_state_place_2025", "6th_state_place_2025", "other_2025", "other_2025", "other_2025"]
    assert p("2025-26", "1st Place Match", "W") == "tbd"


def test_final_state_bouts_are_at_state_alone(spark):
    kind = "season string, wrestler_id int, match_order int, event string, round string, weight_category string, outcome string"
    state, rows = "4A State Championships", []
    rows += [("2024-25", 1, 5, state, "3rd Place Match", "4A 120", "W"), ("2024-25", 1, 6, state, "Final", "4A 120", "L"), ("2024-25", 1, 9, "Winter Open", "1st Place Match", "4A 120", "W")]
    rows += [("2024-25", 2, 5, state, "1st Place Match", "120", "W"), ("2025-26", 1, 3, state, None, "4A 126", "W"), ("2024-25", 3, 1, state, "Round 1", "4A 120", "W"), ("2024-25", 3, 2, state, "Round 2", "4A 120", "W")]
    got = enrich.final_state_bouts(spark.createDataFrame(rows, kind), {"2024-25": "2025"}).select("season", "wrestler_id", "match_order", "place", "is_state_tournament_qualifier", "count_matches")
    assert sorted(map(tuple, got.collect())) == [("2024-25", 1, 5, "3rd_state_place_2025", "state_qualifier_2025", 2), ("2024-25", 3, 2, "other_2025", "state_qualifier_2025", 2), ("2025-26", 1, 3, "tbd", "other", 1)]


def test_opponents_are_listed_or_read_from_the_line(spark):
    people = spark.createDataFrame([(1, "Ann Lee", "North, CO"), (2, "Bo Ray", None), (3, None, "East, CO"), (4, "Di Fox", "GJ")], "wrestler_id int, name string, team string")
    line = "Final - Ann Lee (North) over Cy Day (West High) (Dec 5-2)"
    rows = [(1, 1, 9, line), (2, 1, None, line), (3, 1, 3, line), (4, 1, 2, line), (5, 9, 8, line), (6, 1, 9, "Final - Ann Lee received a bye over Cy Day (West High)"), (7, 1, 4, line), (8, 1, 9, None), (9, 1, 9, "Final - Cy Day (KC) over Ann Lee (North) (Fall)"), (10, 2, 1, "Bo Ray (X) over Ann Lee (North)")]
    got = enrich.with_opponents(spark.createDataFrame(rows, "id int, wrestler_id int, opponent_id int, raw_details string"), people)
    assert {r.id: (r.opponent_name, r.opponent_team) for r in got.collect()} == {
        1: ("Cy Day", "West High"), 2: (None, None), 3: ("Cy Day", "East, CO"), 4: ("Bo Ray", None), 5: (None, None), 6: (None, None), 7: ("Di Fox", "GJ"), 8: (None, None), 9: ("Cy Day", None), 10: ("Ann Lee", "North, CO")}


def test_event_driven_athletes_of_a_state(spark):
    events = spark.createDataFrame([("s", "c", 1, "North, CO"), ("s", "c", None, "South, CO"), ("s", "c", 3, "East, WY"), ("s", "c", None, None)], "season string, category string, team_id int, team_name string")
    people = spark.createDataFrame([("s", "c", i, t, n) for i, t, n in [(10, 1, "x"), (11, 2, "South, CO"), (12, 3, "East, WY")]], "season string, category string, wrestler_id int, team_id int, team string")
    assert {r.wrestler_id for r in enrich.athletes_with_events(events, people, state="CO").collect()} == {10, 11}
    assert {r.wrestler_id for r in enrich.athletes_with_events(events, people).collect()} == {10, 11, 12}


def test_flags_are_carried_one_to_one(spark):
    rows = [("a", "T", "1", 5), ("a", "T", "2", 50), ("b", "T", "1", 6), ("b", "T", "2", 60), ("b", "T", "2", 61), ("c", "T", "1", 7), ("d", "T", "1", 8), ("d", "T", "2", 80)]
    summary = enrich.cross_season_summary(spark.createDataFrame(rows, "name string, team string, season string, wrestler_id int"), ("1", "2"))
    flags = spark.createDataFrame([("a", "1st"), ("b", "2nd"), ("c", "3rd"), ("d", None)], "name string, place string")
    both = summary.join(flags, "name")
    assert sorted(map(tuple, enrich.carried_flags(both, ["place"]).collect()), key=str) == [(50, "1st"), (80, None)]
    assert [tuple(r) for r in enrich.carried_flags(both, ["place"], ["place"]).collect()] == [(50, "1st")]


def test_candidates_of_one_weight(spark):
    names = spark.createDataFrame([(1, "Ann Lee", "North, CO", 106), (2, "Ann Lee", "North, CO", 113), (3, "Ann Lee", "North, CO", None)], "list_id int, name string, school string, weight int")
    found = spark.createDataFrame([("Ann Leah", "North", 106), ("Anne Lee", "North High", 113)], "candidate string, other string, weight int")
    got = matching.best_candidates(names, found, 3, same_weight=True).collect()
    assert {(r.list_id, r.candidate) for r in got} == {(1, "Ann Leah"), (2, "Anne Lee")}
    assert {r.candidate for r in matching.best_candidates(names, found, 3).collect()} == {"Ann Leah"}


def test_elo(spark):
    b = spark.createDataFrame([("s", 1, 1, 10, 20, 1, 24.0), ("s", 2, 2, 20, 30, 0, 30.0), ("t", 1, 3, 10, 20, 0, 24.0)], "season string, bout_no long, id long, wrestler_id long, opponent_id long, won int, k double")
    got = {r["id"]: r for r in ratings.elo(b).collect()}
    assert (got[1]["r_after"], got[1]["o_after"], got[2]["r_before"]) == (1512.0, 1488.0, 1488.0)
    assert all(abs(r["r_before"] + r["o_before"] - r["r_after"] - r["o_after"]) < 0.0011 for r in got.values())
    s = {(r["season"], r["wrestler_id"]): r for r in ratings.elo_summary(ratings.elo(b)).collect()}
    assert s["s", 10]["slope"] is None and s["s", 20]["bouts"] == 2
    z = ratings.composite(spark.createDataFrame([(1, 1.0, 2.0, 3.0), (1, 1.0, 2.0, 3.0)], "p int, r double, d double, o double"), "r", "d", "o", ["p"])
    assert {r["score"] for r in z.collect()} == {0.7}


def test_elo_of_groups_apart_is_that_of_the_whole_pool(spark):
    r = random.Random(5)
    rows = []
    for n in range(300):
        lo = r.choice([0, 10, 20, 30])  # athletes of four groups that never meet
        a, b = r.sample(range(lo, lo + 8), 2)
        rows.append((r.choice(["s", "t", None]), n, n, a, b, r.randrange(2), 24.0 + n % 5))
    df = spark.createDataFrame(rows, "season string, bout_no long, id long, wrestler_id long, opponent_id int, won int, k double").where("season IS NOT NULL")
    whole = ratings.elo(df, split_above=10_000)
    apart = ratings.elo(df, split_above=20)
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, whole.collect()))


def test_groups_are_what_links_connect(spark):
    r = random.Random(3)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("s000", f"s{i:03}") for i in range(1, 50)]
    mixed = [(f"m{r.randrange(40):03}", f"m{r.randrange(40):03}") for _ in range(35)]
    links = chain + star + mixed + [("alone", "alone"), ("n", None)]
    r.shuffle(links)
    up = {x: x for pair in links if None not in pair for x in pair}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = connected_groups(spark.createDataFrame(links, "a string, b string"))
    assert {x.key: x.key_group for x in got.collect()} == {x: root(x) for x in up}


def test_round_factor_tests_final_first(spark):
    f = lambda r: spark.range(1).select(ratings.round_factor(F.lit(r))).first()[0]
    assert [f("Semifinal"), f("Semis"), f("Cons. 2"), f("Consolation")] == [1.25, 1.15, 1.0, 1.05]


def test_texts_that_hold_one_another(spark):
    left, right = ["North High", "N", "ab", "", None, "Abba", "x North High School"], ["north", "North High", "b", "ABBA ", "", None, "zz"]
    rows = matching.theta_pairs(spark.createDataFrame([(x,) for x in left * 2], "a string"), spark.createDataFrame([(x,) for x in right * 2], "b string"), "a", "b").collect()
    wanted = {(a, b) for a in left if a for b in right if b and (a.lower() in b.lower() or b.lower() in a.lower())}
    assert sorted(tuple(r) for r in rows) == sorted(wanted)


def test_best_candidates(spark):
    names = [(1, "Jon Smith", "North High, CO"), (2, "Amy Larsen", "East"), (3, "Bo Reed", "West"), (4, "Cy Stone", "Hill"), (5, "Jon Smith", "South"), (6, None, "East"), (7, "Amy Larsen", None), (8, "Amy Larsen", "East"), (9, "Al O'Neil", "Hill")]
    cands = [("Jon Smyth", "North High"), ("Jon Smithe", "North"), ("Jon Smith", "North"), ("Amy Larson", "East"), ("Amy Lorsen", "East High"), ("Bo Reid", "West"), ("Bo Reed", "Else"), ("Cy Stane", "Other"), ("Al Stonewall", "Hill"), ("Cy Livingstone", "Hill"),
             ("Al O Neil", "hill"), (None, "East"), ("Jon Smith", None)]

    def norm(x):
        return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in x).split()).lower()

    def sound(x):
        letters = [c for c in x.upper() if "A" <= c <= "Z"]
        digit = lambda c: next((str(d) for d, cs in enumerate(("AEIOUYHW", "BFPV", "CGJKQSXZ", "DT", "L", "MN", "R")) if c in cs), "0")
        code, last = letters[0], digit(letters[0])
        for c in letters[1:]:
            if digit(c) != "0" and digit(c) != last:
                code, last = code + digit(c), digit(c)
        return code.ljust(4, "0")

    wanted = []
    for i, name, school in names:
        found = []
        for cand, other in cands:
            if None in (name, school, cand, other):
                continue
            a, b, s, o = norm(name), norm(cand), norm(school.split(",")[0]), norm(other)
            gate = sound(a) == sound(b) or a.split()[-1] in b
            score = (a.split()[0] in b) + (a.split()[-1] in b) + (sound(a) == sound(b)) + (s in o) + (o in s)
            if gate and (s in o or o in s) and score >= 4:
                found.append((-score, cand, other))
        wanted += [(i, name, c, -n) for n, c, _ in sorted(found)[:1]]
    got = matching.best_candidates(spark.createDataFrame(names, "list_id int, name string, school string"), spark.createDataFrame(cands, "candidate string, other string"))
    assert sorted(tuple(r) for r in got.collect()) == wanted
    assert {w[0] for w in wanted} == {1, 2, 3, 4, 8, 9} and (4, "Cy Stone", "Cy Livingstone", 4) in wanted


def test_fixes(spark):
    schools = spark.createDataFrame([("North",), ("East",), ("Lost",), (None,)], "school string")
    teams = spark.createDataFrame([("North High, CO",), ("East A, CO",), ("East B, CO",), (None,)], "team string")
    got = {r["school"]: (r["teams"], r["n_teams"]) for r in matching.school_candidates(schools, teams).collect()}
    assert got["North"] == ("North High, CO", 1) and got["East"] == ("East A, CO , East B, CO", 2) and got["Lost"] == ("", 0)
    manual = spark.createDataFrame([("East A, CO", "East"), (" ", "x"), ("y", "y"), (None, "z"), ("Other", "North")], "to_name string, from_name string")
    assert {tuple(r) for r in matching.school_fixes(schools, teams, manual).select("from_name", "to_name").collect()} == {("North", "North High"), ("East", "East A")}


def test_regional_divisions(spark):
    bouts = [("s", "CHSAA 4A Region 2", "A", 1), ("s", "CHSAA 4A Region 2", "A", 1), ("t", "CHSAA 4A Region 2", "A", 1), ("s", "CHSAA Region", "B", 2), ("s", "Open", "C", 3), ("s", None, "C", 3)]
    teams = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (None, "D")], "team_id int, team string")
    got = enrich.regional_divisions(spark.createDataFrame(bouts, "season string, event string, team string, team_id int"), teams).collect()
    none = ("no_regional_event", "unknown", "unknown")
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(1, "A", "CHSAA 4A Region 2", "4A", "Region 2")] * 2 + [(2, "B", *none), (3, "C", *none), (None, "D", *none)]))


def test_head_to_head(spark):
    bouts = [(1, 2, "W", "Open"), (2, 1, "L", "Open"), (2, 1, "W", "Final"), (3, 1, "W", None), (1, 1, "W", "Open")]
    df = spark.createDataFrame(bouts, "wrestler_id int, opponent_id int, outcome string, event string")
    pairs = spark.createDataFrame([(2, 1), (1, 3), (2, 3)], "first_place_id int, second_place_id int")
    got = {tuple(r) for r in reports.head_to_head(pairs, df, F.col("event") == "Final").collect()}
    assert got == {(2, 1, 2, 0, 1, "second_place_led_series"), (1, 3, 1, 0, 1, "second_place_led_series"), (2, 3, 0, 0, 0, "no_prior_meeting")}


def test_unique_keys_and_sync(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="share keys"):
        enrich.check_unique(df, ["k"])
    with pytest.warns(UserWarning, match="share keys"):
        enrich.check_unique(df, ["k"], abort=False)
    assert enrich.check_unique(df, ["v"]) is df
    name = "boutlake_sync_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        assert [writers.sync_table(df, name), writers.sync_table(df.orderBy("v"), name), writers.sync_table(df.limit(1), name), writers.sync_table(df.limit(1), name, force=True)] == [True, False, True, True]
        assert [tuple(r) for r in readers.list_columns(spark).where(f"table_name = '{name}'").collect()] == [(name, 1, "k", "int"), (name, 2, "v", "string")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tasks(spark):
    t = spark.createDataFrame([("a", "LOCKED", 1, "w1", "2026-01-01 00:00:00"), ("b", "PENDING", 3, None, None), ("c", "PENDING", 0, None, None), ("d", "LOCKED", 3, "w2", "2026-01-01 00:59:00")], "task_id string, status string, attempt_count int, locked_by string, at string")
    t = t.select("task_id", "status", "attempt_count", "locked_by", F.col("at").cast("timestamp").alias("locked_at"), F.lit(None).cast("timestamp").alias("updated_at"))
    now = F.lit("2026-01-01 01:00:00").cast("timestamp")
    got = tasks.claim(tasks.reclaim(t, now), "w9", 1, now)
    assert {r["task_id"]: (r["status"], r["locked_by"], r["attempt_count"]) for r in got.collect()} == {"a": ("LOCKED", "w9", 2), "b": ("PENDING", None, 3), "c": ("PENDING", None, 0), "d": ("LOCKED", "w2", 3)}
    done = tasks.finish(t, "w2", F.lit(True), now)
    assert {r["task_id"]: r["status"] for r in done.collect()}["d"] == "FAILED"


PAGE = """<table><tr><th>Date</th><th>Event</th><th>Weight</th><th>Result</th></tr>
<tr><td>12/05/2025</td><td>Open&nbsp; One</td><td>120</td><td>Final - <a href="/p?wrestlerId=5">Ann Lee</a> (N) over <a href="/p?x=1&amp;wrestlerId=8">Bo</a></td></tr></table>"""


def test_pages(spark):
    df = spark.createDataFrame([(5, PAGE), (6, None)], "wrestler_id long, html string")
    rows = readers.bout_rows(df).collect()
    assert [tuple(r) for r in rows] == [(5, 1, "12/05/2025", "Open One", "120", "Final - Ann Lee (N) over Bo", 8)]
    assert readers.grid_rows(df, "wrestler_id").count() == 2


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", line\nbreak'), (2, None)], "k int, name_link string")
    writers.write_csv(df, str(tmp_path / "out"), rows_per_file=1, gzip=True)
    assert sorted(r[0] for r in readers.read_links(spark, str(tmp_path / "out"), "NAME_LINK").collect()) == ['a "quoted", line\nbreak']
    assert readers.count_rows(spark, str(tmp_path / "out")) == 2


def test_streamed_upsert(spark, tmp_path):
    state = {"df": spark.createDataFrame([(1, "a", None, None)], "k int, v string, created_at timestamp, updated_at timestamp")}
    spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))

    def save(df):
        state["df"] = spark.createDataFrame(df.collect(), df.schema)

    q = refresh.upsert_stream(stream, lambda: state["df"], save, ["k"], ["v"]).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["k"], r["v"]) for r in state["df"].collect()) == [(1, "b"), (2, "c")]


def test_partition_overwrite_keeps_the_other_partitions(spark):
    name = "boutlake_partition_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        first = spark.createDataFrame([("a", 1), ("b", 2)], "season string, id int")
        writers.write_table(first, name, ["season"])
        writers.write_table(spark.createDataFrame([(3, "a"), (4, "a")], "id int, season string"), name, ["season"])
        assert sorted((r["season"], r["id"]) for r in spark.table(name).collect()) == [("a", 3), ("a", 4), ("b", 2)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_ratings_round_as_decimals_do():
    r = random.Random(9)
    for _ in range(20_000):
        points, change = r.randrange(-3000, 3_000_000), r.choice([r.uniform(-45, 45), r.randrange(-90_000, 90_000) / 2000, r.randrange(-90, 90) / 2000])
        wanted = (Decimal(points) / 1000 + Decimal(repr(change))).quantize(Decimal("0.001"), ROUND_HALF_UP)
        assert ratings.moved(points, change) == int(wanted * 1000)
