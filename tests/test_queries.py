"""Every query against its SQL, on the smallest tables."""

import duckdb
import pytest

from boutlake.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    rows = sorted(str(tuple(r[c] for c in sorted(got.columns))) for r in got.collect())
    assert got.columns and (rows or name in ("finalist_pairs", "finalist_report", "list_refresh"))
    if sql := catalog.oracle_sql().get(name):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        order = sorted(range(len(names)), key=lambda i: names[i])
        assert sorted(names) == sorted(got.columns)
        assert rows == sorted(str(tuple(r[i] for i in order)) for r in found.fetchall())


@pytest.mark.parametrize(("name", "key", "wanted"), [
    ("latest_ranking", "wrestler_id", "SELECT p_partkey FROM part"),
    ("insert_ignore", "k", "SELECT o_custkey FROM orders UNION SELECT -1 - o_custkey FROM orders WHERE o_orderstatus <> 'F'"),
    ("replace_by_key", "k", "SELECT o_custkey FROM orders UNION SELECT -1 - o_custkey FROM orders WHERE o_orderstatus <> 'F'"),
    ("school_candidates", "school", "SELECT DISTINCT p_brand || ' ' || p_type FROM part"),
])
def test_whole_tables_take_part(spark, duck, name, key, wanted):
    got = {r[key] for r in catalog.queries()[name](spark, SF).collect()}
    assert {r[0] for r in duck.execute(wanted).fetchall()} <= got


def test_every_customer_is_a_known_opponent(spark, duck):
    got = {r["opponent_team"] for r in catalog.queries()["opponent_resolution"](spark, SF).where("opponent_name LIKE 'Customer#%'").collect()}
    listed = {r[0] for r in duck.execute("SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')").fetchall()}
    assert got & listed and got <= listed | {None}


def test_best_match_finds_misspelt_names(spark):
    rows = catalog.queries()["fuzzy_best_match"](spark, SF).collect()
    assert any(r["name"].split()[-1] != r["candidate"].split()[-1] for r in rows) and all(r["score"] >= 4 for r in rows)
