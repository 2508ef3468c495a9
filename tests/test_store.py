"""Stores of parts, exports with a commit, the queue's timers, names by collation, formats."""

import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from boutlake.functions import compat
from boutlake.sources.export import CsvExport, export_csv, manifest, read_export
from boutlake.sources.shared import shared_path
from boutlake.sources.store import Store
from boutlake.streaming import queue, refresh

KIND = "k int, v string, created_at timestamp, updated_at timestamp"


def now():
    return F.expr("TIMESTAMP '2026-01-02 00:00:00'")


def people(spark, n=200):
    return spark.range(n).selectExpr("CAST(id AS INT) AS k", "concat('v', id) AS v", "TIMESTAMP '2026-01-01 00:00:00' AS created_at", "TIMESTAMP '2026-01-01 00:00:00' AS updated_at")


def folders(store):
    return {p: x.folder for p, x in store.state().parts.items()}


def test_a_merge_rewrites_the_buckets_that_change(spark):
    store = Store.create(people(spark), shared_path(spark, "t"), ["k"], buckets=8)
    before = folders(store)
    assert len(before) == 8 and sum(p.rows for p in store.state().parts.values()) == 200
    batch = spark.createDataFrame([(3, "new"), (5, "v5")], "k int, v string")
    hit = store.merge(batch, ["v"], now())
    after = folders(store)
    assert len(hit) == 1 and {p for p in after if after[p] != before[p]} == hit
    rows = {r.k: (r.v, str(r.updated_at)) for r in store.read().collect()}
    assert rows[3] == ("new", "2026-01-02 00:00:00") and rows[5] == ("v5", "2026-01-01 00:00:00") and len(rows) == 200
    assert {r.k: r.v for r in store.read(0).collect()}[3] == "v3"  # the version before is still there
    assert store.merge(batch, ["v"], now()) == set() and folders(store) == after
    assert sorted(r.k for r in store.lookup(spark.createDataFrame([(3,), (900,)], "k int")).collect()) == [3]


def test_a_stream_leaves_other_buckets_and_repeated_batches_alone(spark, tmp_path):
    store = Store.create(people(spark), shared_path(spark, "t"), ["k"], buckets=16)
    before = folders(store)
    spark.createDataFrame([(7, "a"), (1007, "b")], "k int, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
    q = refresh.merge_stream(stream, store, "pages", ["v"]).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    after = folders(store)
    assert 1 <= len([p for p in after if after[p] != before.get(p)]) <= 2
    assert {r.k: r.v for r in store.read().where("k IN (7, 1007, 8)").collect()} == {7: "a", 1007: "b", 8: "v8"}
    assert store.merge(spark.createDataFrame([(7, "again")], "k int, v string"), ["v"], now(), mark=("pages", 0)) == set()
    assert store.merge(spark.createDataFrame([(7, "later")], "k int, v string"), ["v"], now(), mark=("pages", 1)) != set()


def test_two_writers_do_not_both_commit(spark):
    store = Store.create(people(spark, 5), shared_path(spark, "t"), ["k"], buckets=2)
    state = store.state()
    store.merge(spark.createDataFrame([(1, "x")], "k int, v string"), ["v"], now())
    with pytest.raises(RuntimeError):
        store._commit(type(state)(1, state.schema, state.keys, state.buckets, state.cuts, {}, {}))
    assert store.read().count() == 5
    assert store.vacuum(keep=1) == 1 and store.read().count() == 5
    with pytest.raises(Exception):
        store.state(0)


def test_a_sync_copies_the_ranges_that_differ(spark):
    source = spark.range(3000).selectExpr("id AS k", "concat('v', id) AS v", "CAST(id % 7 AS INT) AS n")
    store = Store.create(source, shared_path(spark, "t"), ["k"], part_rows=200)
    n, before = len(store.state().parts), folders(store)
    assert n > 8 and store.sync(source) == []
    changed = source.withColumn("v", F.when(F.col("k").isin(700, 701, 702), "other").otherwise(F.col("v")))
    copied = store.sync(changed)
    assert 1 <= len(copied) <= 2 and {p for p, f in folders(store).items() if f != before[p]} == set(copied)
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, changed.collect()))
    less = changed.where("k < 100 OR k > 1500").unionAll(spark.createDataFrame([(None, "none", 1), (9999, None, None)], "k long, v string, n int"))
    store.sync(less, batch=2)
    assert sorted(map(str, map(tuple, store.read().collect()))) == sorted(map(str, map(tuple, less.collect())))
    with pytest.raises(ValueError):
        store.sync(source.drop("n"))


def test_a_sync_does_not_join_its_source_to_the_cuts(spark):
    source = spark.range(3000).selectExpr("id AS k", "concat('v', id) AS v")
    store = Store.create(source, shared_path(spark, "t"), ["k"], part_rows=100)
    state = store.state()
    placed = store._placed(store._bounded(source, state, [3, 4]), state).where(F.col("__part").isin([3, 4]))
    assert len(state.cuts) > 20 and "Join" not in placed._jdf.queryExecution().optimizedPlan().toString()
    assert placed.count() == state.parts[3].rows + state.parts[4].rows


def test_a_sync_goes_on_where_it_stopped(spark, monkeypatch):
    source = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    store = Store.create(source, shared_path(spark, "t"), ["k"], part_rows=100)
    changed = source.withColumn("v", F.col("v") + 1)
    plain, calls = Store._commit, []

    def commit(self, state):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("lost")
        plain(self, state)

    monkeypatch.setattr(Store, "_commit", commit)
    with pytest.raises(OSError):
        store.sync(changed, batch=2)
    monkeypatch.setattr(Store, "_commit", plain)
    left = store.sync(changed, batch=2)
    assert 0 < len(left) == len(store.state().parts) - 4
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, changed.collect()))


def test_pages_read_the_ranges_that_hold_them(spark):
    source = spark.range(1000).selectExpr("CASE WHEN id % 50 > 0 THEN id % 37 END AS a", "id AS b").repartition(5)
    store = Store.create(source, shared_path(spark, "t"), ["a", "b"], part_rows=100)
    rows = sorted(map(tuple, source.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for start, size in ((0, 10), (95, 30), (990, 40), (2000, 5), (137, 1)):
        page = store.page(start, size)
        assert list(map(tuple, page.collect())) == rows[start : start + size]
    files = store.page(300, 10).inputFiles()
    assert 1 <= len(files) <= 2 < len(store.state().parts)
    with pytest.raises(ValueError):
        Store.create(source, shared_path(spark, "t"), ["a", "b"], buckets=2).page(0, 1)


def test_stores_of_odd_tables(spark):
    none = Store.create(spark.createDataFrame([], "k string, v int"), shared_path(spark, "t"), ["k"], buckets=4)
    assert none.read().collect() == [] and none.page if none.state().buckets == 0 else True
    dates = spark.range(500).selectExpr("date_add(DATE '2025-01-01', CAST(id AS INT)) AS d", "CAST(id AS DECIMAL(9, 2)) AS m", "id AS v")
    store = Store.create(dates, shared_path(spark, "t"), ["d", "m"], part_rows=60)
    assert len(store.state().parts) > 3 and store.sync(dates) == [] and [r.v for r in store.page(120, 3).collect()] == [120, 121, 122]
    other = dates.withColumn("v", F.when(F.col("v") == 499, -1).otherwise(F.col("v")))
    assert len(store.sync(other)) == 1 and store.read().where("v = -1").count() == 1


def test_an_export_has_one_mark_a_file_and_counts(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    df = spark.createDataFrame([(3, 'a "b", c\nd', None), (1, "", True), (2, None, False)], "k int, `the text` string, b boolean")
    found = export_csv(df, path, ["k"], rows_per_file=2)
    files = [tmp_path / "out" / f["name"] for f in found["files"]]
    assert found["rows"] == 3 and max(f["rows"] for f in found["files"]) <= 2 and [f["bytes"] for f in found["files"]] == [os.path.getsize(f) for f in files]
    text = [f.read_bytes() for f in files]
    assert all(t.startswith(b'\xef\xbb\xbf"k","the text","b"\n') and t.count(b"\xef\xbb\xbf") == 1 for t in text)
    assert b"".join(t.partition(b"\n")[2] for t in text) == b'"1","","true"\n"2",,"false"\n"3","a ""b"", c\nd",\n'
    got = read_export(spark, path, "k int, t string, b boolean").collect()
    assert sorted((r.k, r.t or "", r.b) for r in got) == [(1, "", True), (2, "", False), (3, 'a "b", c\nd', None)]


def test_an_export_archives_the_run_before_once_it_is_committed(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    one = export_csv(spark.range(10).toDF("k"), path, rows_per_file=4, gzip=True, bom=False)
    assert 3 <= len(one["files"]) <= 6 and gzip.decompress((tmp_path / "out" / one["files"][0]["name"]).read_bytes()).startswith(b'"k"\n')
    broken = spark.range(10).selectExpr("CASE WHEN id = 7 THEN raise_error('lost') ELSE id END AS k")
    spark.dataSource.register(CsvExport)
    with pytest.raises(Exception, match="lost"):
        broken.selectExpr("CAST(k AS STRING) AS k").write.format("csv_export").mode("overwrite").save(path)
    assert manifest(path) == one and read_export(spark, path, "k int").count() == 10
    assert [x for x in os.listdir(tmp_path / "out") if x.startswith("run-")] == [one["run"]]
    two = export_csv(spark.range(3).toDF("k"), path)
    assert os.listdir(tmp_path / "out" / "archive") == [one["run"]] and read_export(spark, path, "k int").count() == 3 == two["rows"]
    none = export_csv(spark.range(0).toDF("k"), path)
    assert none["files"] == [] and read_export(spark, path, "k int").collect() == []
    assert json.loads((tmp_path / "out" / "manifest.json").read_text()) == none


def test_a_lock_expires_and_is_claimed_again(spark, tmp_path):
    t = lambda h, m=0: datetime(2026, 1, 5, h, m)
    steps = [
        [("a", "seed", None, t(10)), ("b", "seed", None, t(10)), ("a", "claim", "w1", t(10, 1)), ("a", "claim", "w2", t(10, 2)), ("b", "claim", "w2", t(10, 2)), ("b", "done", "w1", t(10, 3)), ("b", "done", "w2", t(10, 4))],
        [("c", "seed", None, t(11))],  # moves the watermark beyond the end of a's lock
        [("a", "claim", "w3", t(11, 1)), ("a", "failed", "w3", t(11, 2)), ("a", "claim", "w4", t(11, 3))],
        [("c", "claim", "w1", t(13))],
        [("c", "seed", None, t(13, 50))],
    ]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", queue.PROVIDER)
    try:
        for i, rows in enumerate(steps):
            spark.createDataFrame(rows, "task_id string, event string, worker string, at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            events = spark.readStream.schema("task_id string, event string, worker string, at timestamp").parquet(str(tmp_path / "in"))
            q = queue.queue_changes(events, "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            q.awaitTermination(180)
            assert q.exception() is None
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    a = [(r.change, r.status, r.attempts, r.locked_by, r.at) for r in sorted(rows, key=lambda r: r.at) if r.task_id == "a"]
    assert a == [
        ("seeded", "PENDING", 0, None, t(10)), ("claimed", "LOCKED", 1, "w1", t(10, 1)), ("expired", "PENDING", 1, None, t(10, 31)), ("claimed", "LOCKED", 2, "w3", t(11, 1)),
        ("failed", "PENDING", 2, None, t(11, 2)), ("claimed", "LOCKED", 3, "w4", t(11, 3)), ("expired", "FAILED", 3, None, t(11, 33))]
    assert [(r.change, r.status) for r in sorted(rows, key=lambda r: r.at) if r.task_id == "b"] == [("seeded", "PENDING"), ("claimed", "LOCKED"), ("done", "DONE")]


def test_names_that_differ_in_marks_case_or_width_meet(spark):
    names = ["Łukasz", "lukasz", "Ｌukasz", "Nuñez", "Nuñez", "NUNEZ", " Ann\xa0 Lee ", "Ann Lee", "Bo", None, None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").withColumn("key", compat.name_key(F.col("n")))
    groups = {tuple(sorted(r.l)) for r in df.groupBy("key").agg(F.collect_list("i").alias("l")).collect()}
    assert groups == {(0, 1, 2), (3, 4, 5), (6, 7), (8,), (9, 10)}
    other = spark.createDataFrame([("LUKASZ",), ("nuñez",), (None,)], "m string").withColumn("other", compat.name_key(F.col("m")))
    assert sorted(r.i for r in df.join(other, F.col("key") == F.col("other")).collect()) == [0, 1, 2, 3, 4, 5]
    assert [r[0] for r in df.orderBy("i").select(compat.norm_key(F.col("n"))).collect()][2:7] == ["lukasz", "nunez", "nunez", "nunez", "ann lee"]


def test_formats(spark):
    at = F.lit(datetime(2026, 3, 7, 14, 5, 9))
    f = lambda p: spark.range(1).select(compat.date_text(at, p)).first()[0]
    assert [f(p) for p in ("YYYY-MM-DD HH:mm:ss", "MM/DD/YYYY hh:mm A", "ddd, MMM D", "dddd MMMM", "YY [Day] D", "M/D/YYYY h:mm")] == ["2026-03-07 14:05:09", "03/07/2026 02:05 PM", "Sat, Mar 7", "Saturday March", "26 Day 7", "3/7/2026 2:05"]
    assert spark.range(1).select(compat.number_text(F.lit(1234567.891), 2), compat.number_text(F.lit(12)), compat.day_of_week(at)).first()[:] == ("1,234,567.89", "12", 7)
