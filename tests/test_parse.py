import pytest
from pyspark.sql import functions as F

from boutlake.functions import compat, parse
from boutlake.operators import records

ME, TEAM = "Ann Van Der Berg", "North High, CO"

CASES = [
    # line, round, result, score, outcome, counts, varsity
    ("Varsity - Final - Ann Van Der Berg (North High) over Bo Ray (South) (Dec 5-2)", "Final", "over", "Dec 5-2", "W", 1, 1),
    ("Semifinal - Bo Ray (South) over Ann Van Der Berg (North High) (Fall 1:20)", "Semifinal", "over", "Fall 1:20", "L", 1, 0),
    ("Ann Van Der Berg (North High) over Bo Ray (South) (MFF)", None, "over", "MFF", "W", 1, 0),
    ("Varsity - Ann Van Der Berg (North High) over Bo Ray (South) (Dec 1-0)", "Varsity", "over", "Dec 1-0", "W", 1, 1),
    ("Ann Van Der Berg (North High) - x over Bo Ray", None, "over", "North High) - x over Bo Ray", "W", 1, 0),
    ("Round 1 - Ann Van Der Berg received a bye", "Round 1", "bye", "Bye", "bye", 0, 0),
    ("Round 1 - Ann Van Der Berg (North High) over Bo Byers (South) (Dec 5-2)", "Round 1", "over", "Dec 5-2", "bye", 0, 0),
    ("Exhibition - Ann Van Der Berg over Bo Ray (Dec 2-1)", "Exhibition", "over", "Dec 2-1", "U", 0, 0),
    ("Round 2 - Ann Van Der Berg and Bo Ray wrestled to a draw (3-3)", "Round 2", None, "3-3", "T", 1, 0),
    ("Round 2 - Ann Van Der Berg over Unknown (For.)", "Round 2", "over", "For.", "W", 1, 0),
    ("Dual - Ann Van Der Berg (North High) vs. Bo Ray (South)", "Dual", None, "vs. no winner info", "U", 1, 0),
    ("Round 3 - Berg (North High) over Bo Ray (South) (Inj. Def.)", "Round 3", "over", "Inj. Def.", "W", 1, 0),
    ("Round 3 - Bo Ray (South) over Somebody (North High) (DQ)", "Round 3", "over", "DQ", "L", 1, 0),
    ("Round 3 - Berg (North High) over Cy (North High) (Dec 1-0)", "Round 3", "over", "Dec 1-0", "U", 1, 0),
    ("JV - Bo Ray\r\n(South) over Ann Van Der Berg (Dec 3-1)", "JV", "over", "Dec 3-1", "L", 1, 0),
    ("Round 3 - Cy (East) over Bo Ray (South) (Dec 3-1)", "Round 3", "over", "Dec 3-1", "U", 1, 0),
    ("no segments", None, None, None, "U", 1, 0),
    ("", None, None, None, "U", 1, 0),
    (None, None, None, None, "U", 1, 0),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0], ME, TEAM) for i, c in enumerate(CASES)], "i int, raw_details string, wrestler_name string, wrestler_team string")
    return {r["i"]: r for r in parse.with_bout(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_bout_lines(parsed, i):
    r = parsed[i]
    assert (r["round"], r["result"], r["score_details"], r["outcome"], r["counts_in_record"], r["is_varsity"]) == CASES[i][1:]


def test_strict_byes_are_whole_words(spark):
    df = spark.createDataFrame([("R - Ann Lee (N) over Bo Byers (S) (Dec 5-2)", "Ann Lee", None)], "raw_details string, wrestler_name string, wrestler_team string")
    assert parse.with_bout(df, strict=True).first()["outcome"] == "W"


@pytest.mark.parametrize(("name", "first", "last"), [("Ann Lee", "Ann", "Lee"), ("Ann Van Der Berg", "Ann", "Van Der Berg"), ("Ann de la Cruz Jr.", "Ann", "de la Cruz"), ("Ann St. John (NORTH)", "Ann", "St. John"), ("Ann", "", "Ann"), ("Ann Mary Lee III", "Ann Mary", "Lee")])
def test_names(spark, name, first, last):
    n = parse.clean_name(F.lit(name))
    assert tuple(spark.range(1).select(parse.first_name(n), parse.last_name(n)).first()) == (first, last)


def test_list_names_and_records(spark):
    df = spark.createDataFrame([("Lee, Ann", "12-3"), ("Ann", "x"), (None, "0-0")], "n string, r string")
    rows = df.select(*parse.parse_list_name(F.col("n")), *parse.parse_record(F.col("r"))).collect()
    assert [tuple(r) for r in rows] == [("Ann", "Lee", 12, 3, 0.8), (None, "Ann", None, None, None), (None, None, 0, 0, None)]


def test_strict_outcomes(spark):
    """Whole words for signs, full names for sides, also around "def."."""
    lines = {
        "Varsity - Final - Ann Lee (North) over Bo Ray (South) (Dec 5-2)": ("W", 1, 1), "Final - Bo Ray (South) def. Ann Lee (North) (Fall)": ("L", 1, 0), "Final - Lee (North) over Bo Ray (South)": ("U", 1, 0),
        "Final - Ann Lee over Byers (Tieman)": ("W", 1, 0), "Ann Lee received a bye": ("bye", 0, 0), "Ann Lee and Bo Ray wrestled to a draw": ("T", 1, 0), "Exhibition - Ann Lee over Bo": ("U", 0, 0),
        "JV - Varsity - Ann Lee over Unknown (For.)": ("W", 1, 0), "Ann Lee vs. Bo Ray": ("U", 1, 0), "varsity": ("U", 1, 0), None: ("U", 1, 0)}
    df = spark.createDataFrame([(x, "Ann Lee", "North, CO") for x in lines], "raw_details string, wrestler_name string, wrestler_team string")
    assert {r.raw_details: (r.outcome, r.counts_in_record, r.is_varsity) for r in parse.with_bout(df, strict=True).collect()} == lines
    nameless = spark.createDataFrame([("Final - A over B", None, "North"), ("Final - North over B", None, "North, CO")], df.schema)
    assert {(r.me_before, r.outcome) for r in parse.with_bout(nameless).collect()} == {(0, "U")}


@pytest.mark.parametrize(("text", "start", "end"), [("12/05/2025", "2025-12-05", "2025-12-05"), ("12/05 - 12/06/2025", "2025-12-05", "2025-12-06"), ("1/2/25 - 1/3/26", "2025-01-02", "2026-01-03"), ("3/5-7/2025", "2025-03-05", "2025-03-07"), ("02/30/2025", None, None), ("", None, None), (None, None, None)])
def test_dates(spark, text, start, end):
    df = spark.createDataFrame([(text,)], "t string")
    a, b = compat.date_range(F.col("t"))
    assert tuple(df.select(a.cast("string"), b.cast("string")).first()) == (start, end)


def test_soundex_is_not_cut(spark):
    wanted = {"Robert": "R163", "Washington": "W25235", "Tymczak": "T520", "Ann Lee": "A540", "Pfister": "P236", "12": "", "": "", None: None}
    df = spark.createDataFrame([(n,) for n in wanted], "n string")
    assert {r[0]: r[1] for r in df.select("n", compat.soundex_full("n")).collect()} == wanted


def test_keys_and_params(spark):
    df = spark.createDataFrame([(" José  Peña ", "http://x/y?a=1&wrestlerId=77#z")], "n string, u string")
    assert tuple(df.select(compat.norm_key(F.col("n")), compat.query_param(F.col("u"), "wrestlerId"), compat.query_param(F.col("u"), "b")).first()) == ("jose pena", "77", None)


def test_running_sums_are_consistent(spark):
    data = [(i, "s", i % 3, None if i == 4 else i, "WLTUbye"[(i * 7) % 4] if i % 5 else "bye", 0 if i % 5 == 0 else 1, i % 2) for i in range(40)]
    df = records.running_records(spark.createDataFrame(data, "id int, season string, wrestler_id int, match_order int, outcome string, counts_in_record int, is_varsity int"))
    rows = df.orderBy("wrestler_id", F.col("match_order").asc_nulls_first(), "id").collect()
    last = {}
    for r in rows:
        now = (r.wins_run, r.losses_run, r.ties_run, r.total_matches)
        assert sum(now[:3]) <= now[3] and all(a <= b for a, b in zip(last.get(r.wrestler_id, (0,) * 4), now, strict=True))
        last[r.wrestler_id] = now
    assert df.count() == 40


def test_a_range_of_dates_is_taken_apart_once(spark):
    df = spark.createDataFrame([("12/05-07/2025\n",), ("12/30 - 1/2/26",), ("1/2/202",)], "t string")
    found = df.select(*(c.cast("string") for c in compat.date_range(F.col("t"))))
    assert "regexp_extract(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert list(map(tuple, found.collect())) == [("2025-12-05", "2025-12-07"), ("2026-12-30", "2026-01-02"), (None, None)]
