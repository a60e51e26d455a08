"""Stored tables: whole or unchanged, merged by key, followed by days."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from events import purchase, rows_of, shards, visit
from shopgauge.operators import incremental, marts, quality, ranking, raw, staging
from shopgauge.plans import job
from shopgauge.sources import snapshots, tables
from shopgauge.sources.shards import SUFFIX

ROWS = "id int, v string, day string"


def table(spark, path, rows, by="day"):
    snapshots.replace_all(spark.createDataFrame(rows, ROWS), path, by)


def stored(spark, path):
    return rows_of(snapshots.read(spark, path, ROWS))


def test_a_write_that_breaks_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not snapshots.exists(spark, path)
    snapshots.create(spark, path)
    assert snapshots.exists(spark, path) and stored(spark, path) == []
    table(spark, path, [(1, "a", "1"), (2, "b", "2")])
    before = stored(spark, path)
    reader = snapshots.read(spark, path, ROWS)
    broken = spark.createDataFrame([(3, "x", "2"), (4, "no number", "3")], ROWS).withColumn(
        "id", F.when(F.col("id") == 4, F.col("v").cast("int")).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="no number"):
        tables.reload_days(broken, path, ["2", "3"], "day")
    assert stored(spark, path) == before
    tables.reload_days(broken.where("v = 'x'"), path, ["2", "3"], "day")
    assert stored(spark, path) == [(1, "a", "1"), (3, "x", "2")]
    assert rows_of(reader) == before  # a reader goes on with what it began with
    assert snapshots.partitions(spark, path) == ["day=1", "day=2"]
    snapshots.expire(spark, path, 1)
    assert stored(spark, path) == [(1, "a", "1"), (3, "x", "2")]
    table(spark, path, [(9, "z", "9")])
    assert snapshots.expire(spark, path, 1) == 2  # the writes of both days


def test_named_days_without_rows_go(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(1, "a", "1"), (2, "b", None)])
    none = spark.createDataFrame([], ROWS)
    tables.reload_days(none, path, [None, "7"], "day")
    assert stored(spark, path) == [(1, "a", "1")]
    tables.reload_days(none, path, ["1"], "day")
    assert stored(spark, path) == [] and snapshots.partitions(spark, path) == []
    tables.reload_days(none, path, [], "day")
    assert stored(spark, path) == []


def test_columns_follow_the_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(1, "a", "1")])
    more = spark.createDataFrame([(2, 1.5, "2")], "id int, added double, day string")
    snapshots.replace_partitions(more, path, "day")
    got = snapshots.read(spark, path, "added double, id int, day string")
    assert sorted(map(tuple, got.collect()), key=repr) == [(1.5, 2, "2"), (None, 1, "1")]


def test_two_writers_do_not_publish_the_same_number(spark, tmp_path):
    files = snapshots._Files(spark, str(tmp_path))
    files.publish(f"{tmp_path}/manifest/1", "a")
    with pytest.raises(RuntimeError, match="another writer"):
        files.publish(f"{tmp_path}/manifest/1", "b")
    assert files.names(f"{tmp_path}/manifest") == ["1"]


def test_appends_are_joined(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        snapshots.append(spark.createDataFrame([(k, "v", "d")], ROWS), path)
    assert not snapshots.compact(spark, path, ROWS, 4)
    assert snapshots.compact(spark, path, ROWS, 3)
    assert len(snapshots.folders(spark, path)) == 1
    assert [r[0] for r in stored(spark, path)] == [0, 1, 2, 3]


def test_a_report_that_breaks_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "reports" / "r")
    good = spark.createDataFrame([("1", "a")], "n string, v string")
    tables.write_report(good, path)
    with pytest.raises(Exception, match="no number"):
        tables.write_report(good.select(F.lit("no number").cast("int").alias("n") + F.length("v")), path)
    back = lambda: [tuple(r) for r in spark.read.option("header", True).csv(path).collect()]
    assert back() == [("1", "a")]
    tables.write_report(good.union(good), path)
    assert back() == [("1", "a")] * 2 and [f.name for f in (tmp_path / "reports").iterdir()] == ["r"]


def test_merge_rewrites_only_days_that_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, [(k, "old", str(k % 4)) for k in range(12)])
    before = set(snapshots.folders(spark, path))
    batch = spark.createDataFrame([(1, "moved", "2"), (50, "new", "5")], ROWS)
    gone = spark.createDataFrame([(2,)], "id int")
    assert sorted(tables.merge_by_key(batch, path, "id", "day", gone)) == ["1", "2", "5"]
    after = set(snapshots.folders(spark, path))
    assert {f.split("/")[1] for f in before & after} == {"day=0", "day=3"}
    expected = {k: ("old", str(k % 4)) for k in range(12) if k != 2} | {1: ("moved", "2"), 50: ("new", "5")}
    assert {r[0]: r[1:] for r in stored(spark, path)} == expected
    tables.merge_by_key(batch, path, "id", "day", gone)
    assert {r[0]: r[1:] for r in stored(spark, path)} == expected


ITEMS = [{"item_id": "i", "item_name": "n", "quantity": 2, "item_revenue_in_usd": 3.0}]


def some_days():
    return [
        visit("20240101", "u", 1, "23:50:00", {"page_location": "/one"}),
        visit("20240102", "u", 1, "00:10:00", {"page_location": "/two"}),
        visit("20240102", "v", 7),
        purchase("20240102", "v", "t1", items=ITEMS),
        purchase("20240103", "u", "t2", items=ITEMS),
        purchase("20240104", "v", "t1", items=ITEMS),
    ]


def test_a_daily_run_opens_only_the_shards_concerned(spark, tmp_path, monkeypatch):
    """Every read of raw tables while days are staged is filtered by shard day, and nothing else changes."""
    root = str(tmp_path)
    wh = job.Warehouse(spark, root)
    wh.ensure_raw()
    source = shards(spark, some_days())
    job.backfill(wh, source, ["20240101", "20240102", "20240103", "20240104"])
    job.stage(wh, None)
    job.build_marts(wh)
    kept = {name: set(snapshots.folders(spark, wh.path(name))) for name in job.BY_DAY}
    emptied = source.where(F.col(SUFFIX) != "20240103")
    job.load_each(wh, emptied, ["20240103"])
    plans = []

    def noted(write):
        def seen(rows, *rest):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            return write(rows, *rest)

        return seen

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_write", noted(snapshots._write))
        patch.setattr(job, "store", noted(job.store))
        spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
        job.stage(wh, ["20240103"])
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for plan in plans for line in plan.split("\n") if "FileScan" in line and "/raw_" in line]
    assert scans and all("PartitionFilters: [" in line and SUFFIX in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    for name, (_, column) in job.STAGED_BY_DAY.items():
        same = {f.split("/")[1] for f in kept[name] & set(snapshots.folders(spark, wh.path(name)))}
        assert f"{column}=2024-01-02" in same or name == "stg_sessions"
    job.build_marts(wh)
    whole = job.Warehouse(spark, str(tmp_path / "whole"))
    whole.ensure_raw()
    job.backfill(whole, emptied, ["20240101", "20240102", "20240104"])
    job.stage(whole, None)
    job.build_marts(whole)
    for name in [*job.STAGED_BY_DAY, "stg_users", *job.MARTS]:
        a, b = wh.table(name), whole.table(name)
        assert rows_of(a, *sorted(a.columns)) == rows_of(b, *sorted(a.columns)), name


def test_states_by_day_merge_to_the_whole(spark):
    events = raw.raw_events(shards(spark, some_days()))
    items = staging.purchase_items(raw.raw_purchase_items(shards(spark, some_days())))
    bought = staging.purchases(events)
    whole = staging.users(events, bought)
    assert rows_of(staging.users_of(staging.user_visits(events, SUFFIX), bought)) == rows_of(whole)
    totals, merged = marts.product_totals(items), marts.product_totals_of(marts.product_days(items), marts.product_orders(items))
    assert rows_of(merged, *sorted(totals.columns)) == rows_of(totals, *sorted(totals.columns))
    assert rows_of(totals, "orders") == [(2,)]  # t1 on two days is one order
    index = incremental.session_days(events)
    touched = index.where(f"{SUFFIX} = '20240102'").select("session_key").distinct()
    assert rows_of(incremental.rebuild_sessions(events, touched, index)) == rows_of(incremental.rebuild_sessions(events, touched))
    later = staging.users_of(staging.user_visits(events, SUFFIX), bought.where("purchase_date > '2024-01-02'"))
    assert [str(d) for (d,) in rows_of(staging.moved_first_purchases(whole, later))] == ["2024-01-02", "2024-01-04"]


def test_checks_in_one_pass_equal_single_checks(spark):
    rows = [(1, "a", 1), (1, None, 2), (None, "b", 3), (None, "b", 4), (2, "c", -1)]
    df = spark.createDataFrame(rows, "k int, v string, n int")
    negative = {"n_positive": F.col("n") < 0}
    for some in (df, df.where("k = 9")):
        one = quality.table_checks("t", some, "k", ["k", "v"], negative)
        each = [quality.unique("t", some, "k"), quality.not_null("t", some, ["k", "v"]), quality.assertion("n_positive", some, negative["n_positive"])]
        assert rows_of(one) == rows_of(quality.combine(each))
        assert rows_of(quality.table_checks("t", some, None, ["v"])) == rows_of(quality.not_null("t", some, ["v"]))
    scans = quality.table_checks("t", df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert scans.count("Scan ExistingRDD") == 1


def test_top_rows_have_the_ranks_of_all(spark):
    rows = [(k, None if k % 11 == 0 else k * 7 % 13, None if k % 5 == 0 else k % 4) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    ranks = {"ra": "a", "rb": "b"}
    every = ranking.global_ranks(df, ranks, 8)
    for by in ranks:
        best = every.orderBy(by, "id").limit(20)
        got = ranking.top_with_ranks(df, ranks, by, 20, ["id"])
        assert got.columns == every.columns and rows_of(got) == rows_of(best)
    assert ranking.top_with_ranks(df.where("id < 0"), ranks, "ra", 5, ["id"]).isEmpty()
