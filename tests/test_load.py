"""Day reload, discovery, ledger, incremental refresh and the whole job."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from events import purchase, rows_of, shards, visit
from shopgauge.operators import discovery, incremental, quality, raw, staging
from shopgauge.plans import job
from shopgauge.schemas import PIPELINE_RUNS, RAW_EVENTS
from shopgauge.sources import tables
from shopgauge.sources.driver_tables import web_shards
from shopgauge.sources.shards import read_shards, shard_row_counts

ITEMS = [{"item_id": "i", "item_name": "n", "quantity": 2, "item_revenue_in_usd": 3.0}]


def three_days():
    return [
        visit("20240101", "u", 1, "23:50:00", {"page_location": "/one"}),
        visit("20240102", "u", 1, "00:10:00", {"page_location": "/two"}),
        visit("20240102", "v", 7),
        purchase("20240102", "v", "t1", items=ITEMS),
        purchase("20240103", "u", "t2", items=ITEMS),
    ]


def per_day(spark, path):
    return dict(rows_of(shard_row_counts(tables.read_table(spark, path, RAW_EVENTS))))


def test_reload_is_idempotent_and_clears_empty_days(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.create_if_absent(spark, path, RAW_EVENTS)
    tables.create_if_absent(spark, path, RAW_EVENTS)
    assert per_day(spark, path) == {}
    events = raw.raw_events(shards(spark, three_days()))
    tables.reload_days(events, path, cluster_by=job.EVENT_ORDER)
    for _ in range(2):
        tables.reload_day(events, path, "20240102")
        assert per_day(spark, path) == {"20240101": 1, "20240102": 3, "20240103": 1}
    less = events.where(F.col("source_table_suffix") != "20240102")
    tables.reload_days(less, path, ["20240102", "20240103"])
    assert per_day(spark, path) == {"20240101": 1, "20240103": 1}
    tables.reload_day(less.where(F.lit(False)), path, "20240103")
    assert per_day(spark, path) == {"20240101": 1}


def test_reading_a_range_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "shards")
    shards(spark, three_days()).write.partitionBy("source_table_suffix").parquet(path)
    ranged = read_shards(spark, path, "20240102", "20240102")
    assert ranged.count() == 3
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_table_suffix" in plan


def ledger(spark, rows):
    began = datetime(2024, 1, 1, 6)
    full = [
        (str(i), day, layer, status, count, None, began, began, 0.0)
        for i, (day, layer, status, count) in enumerate(rows)
    ]
    return spark.createDataFrame(full, ", ".join(f"{n} {k}" for n, k in PIPELINE_RUNS.items()))


def test_discovery(spark):
    source = shards(spark, three_days())
    runs = ledger(
        spark,
        [
            (date(2024, 1, 1), "raw", "success", 1),
            (date(2024, 1, 1), "raw", "failed", 0),  # a later failure changes nothing
            (date(2024, 1, 2), "raw", "success", 3),
            (date(2024, 1, 3), "raw", "failed", 0),
            (date(2024, 1, 3), "mart", "success", 0),
        ],
    )
    assert rows_of(discovery.completed_dates(runs)) == [("20240101",), ("20240102",)]
    assert rows_of(discovery.missing_dates(source, runs)) == [("20240103",)]
    late = shards(spark, three_days()[:1] + three_days()[2:])
    assert rows_of(discovery.incomplete_dates(source, late)) == [("20240102",)]
    assert rows_of(discovery.incomplete_dates(late, source)) == []
    assert discovery.day_list(discovery.dates_to_process(source, late, runs)) == [
        "20240102",
        "20240103",
    ]
    only = discovery.dates_to_process(source, late, runs, override="20240101")
    assert discovery.day_list(only) == ["20240101"]


def test_lookback_limits_the_comparison(spark):
    source, none = shards(spark, three_days()), shards(spark, [])
    today = F.lit("2024-01-03").cast("date")
    found = discovery.incomplete_dates(source, none, lookback_days=1, today=today)
    assert rows_of(found) == [("20240102",), ("20240103",)]


def test_ledger_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.create_if_absent(spark, path, PIPELINE_RUNS)
    began, ended = datetime(2024, 1, 5, 6), datetime(2024, 1, 5, 6, 1, 30)
    day = spark.createDataFrame([("20240104", 12)], "date_suffix string, rows_processed bigint")
    none, later = F.lit(None), F.lit(ended)
    tables.append_runs(discovery.ledger_runs(day, F.lit("success"), none, F.lit(began), later), path)
    bad = day.withColumn("date_suffix", F.lit("20240105"))
    error = F.lit("it's \"bad\"")
    tables.append_runs(discovery.ledger_runs(bad, F.lit("failed"), error, none.cast("timestamp"), later), path)
    stored = tables.read_table(spark, path, PIPELINE_RUNS)
    got = rows_of(stored, "status", "rows_processed", "duration_seconds", "error_message")
    assert got == [("failed", 0, None, 'it\'s "bad"'), ("success", 12, 90.0, None)]
    assert stored.select("run_id").distinct().count() == 2
    recent = discovery.recent_runs(stored, F.lit(datetime(2024, 1, 12, 6)))
    assert [r.status for r in recent.collect()] == ["success"]
    assert discovery.recent_runs(stored, F.lit(datetime(2024, 1, 12, 7))).count() == 0


def test_anomaly_uses_the_days_before(spark):
    counts = [100, 100, 130, 100]
    runs = ledger(
        spark, [(date(2024, 1, d + 1), "raw", "success", n) for d, n in enumerate(counts)]
    )
    assert rows_of(discovery.row_count_anomaly(runs)) == [(date(2024, 1, 3), 130, 100.0)]


def test_upsert_twice_is_once_and_syncs_columns(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, gone int")
    batch = spark.createDataFrame([(2, "B", 1.5), (3, "c", 2.5)], "id int, v string, added double")
    once = incremental.upsert(target, batch, "id")
    assert rows_of(once) == [(1, "a", None), (2, "B", 1.5), (3, "c", 2.5)]
    assert once.columns == ["id", "v", "added"]
    assert rows_of(incremental.upsert(once, batch, "id")) == rows_of(once)


def test_watermark(spark):
    rows = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    target = rows.where("d < '2024-01-03'").withColumnRenamed("d", "done")
    assert rows_of(incremental.after_watermark(rows, target, "d", "done")) == [(date(2024, 1, 3),)]
    empty = target.where(F.lit(False))
    assert incremental.after_watermark(rows, empty, "d", "done").count() == 3


def test_session_refresh_equals_full_build(spark):
    later = three_days()
    earlier = later[1:]  # the day on which the session began arrives late
    before, after = (raw.raw_events(shards(spark, r)) for r in (earlier, later))
    target = staging.sessions(before)
    days = ["20240101"]
    touched = incremental.touched_sessions(before, days).union(
        incremental.touched_sessions(after, days)
    )
    refreshed = incremental.refresh_sessions(target, after, touched.distinct())
    assert rows_of(refreshed) == rows_of(staging.sessions(after))
    back = incremental.refresh_sessions(refreshed, before, touched.distinct())
    assert rows_of(back) == rows_of(target)


def test_replace_days(spark):
    old = spark.createDataFrame([(date(2024, 1, d), "old") for d in (1, 2)], "d date, v string")
    new = spark.createDataFrame([(date(2024, 1, d), "new") for d in (2, 3)], "d date, v string")
    got = incremental.replace_days(old, new, "d", [date(2024, 1, 2)])
    assert rows_of(got) == [(date(2024, 1, 1), "old"), (date(2024, 1, 2), "new")]


def stored(wh):
    staged = ["stg_sessions", "stg_purchases", "stg_purchase_items", "stg_users"]
    names = [*staged, "mart_daily_metrics", "mart_weekly_metrics", "mart_product_metrics"]
    return {name: rows_of(wh.table(name), *sorted(wh.table(name).columns)) for name in names}


def test_job_day_by_day_equals_full_run(spark, tmp_path):
    everything = three_days()
    late = everything[1:4]  # day 1 and day 3 are yet to come
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    assert job.run(spark, shards(spark, late), step) == {"days": ["20240102"]}
    assert job.run(spark, shards(spark, late), step) == {"days": []}
    assert job.run(spark, shards(spark, everything), step) == {"days": ["20240101", "20240103"]}
    job.run(spark, shards(spark, everything), whole)
    assert stored(job.Warehouse(spark, step)) == stored(job.Warehouse(spark, whole))
    report = spark.read.option("header", True).csv(f"{step}/reports/daily_metrics")
    assert report.columns[0] == "Date"
    assert [r["Date"] for r in report.collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    runs = job.Warehouse(spark, step).ledger()
    assert rows_of(runs.where("layer = 'raw'"), "run_date", "status", "rows_processed") == [
        (date(2024, 1, 1), "success", 1),
        (date(2024, 1, 2), "success", 4),
        (date(2024, 1, 3), "success", 2),
    ]


def test_job_with_override_reloads_one_day(spark, tmp_path):
    root = str(tmp_path)
    job.run(spark, shards(spark, three_days()), root)
    fewer = [r for r in three_days() if r["user_pseudo_id"] != "v"]
    assert job.run(spark, shards(spark, fewer), root, override="20240102")["days"] == ["20240102"]
    wh = job.Warehouse(spark, root)
    assert rows_of(wh.table("stg_sessions"), "user_pseudo_id") == [("u",)]
    assert rows_of(wh.table("stg_purchases"), "transaction_id") == [("t2",)]


def test_failed_day_is_recorded_and_the_rest_loaded(spark, tmp_path):
    root = str(tmp_path)
    job.run(spark, shards(spark, three_days()[:1]), root)
    bad = visit("20240104", "u", 9)
    bad["event_date"] = "not a day"
    source = shards(spark, three_days() + [bad])
    with pytest.raises(RuntimeError, match="20240104"):
        job.run(spark, source, root)
    wh = job.Warehouse(spark, root)
    status = dict(rows_of(wh.ledger().where("layer = 'raw'"), "run_date", "status"))
    assert status[date(2024, 1, 4)] == "failed"
    assert status[date(2024, 1, 3)] == "success"
    assert wh.table("stg_purchases").count() == 2


def test_failing_check_stops_the_reports(spark, tmp_path):
    root = str(tmp_path)
    orphan = purchase("20240101", "u", "t", params=(), items=ITEMS)
    with pytest.raises(quality.CheckFailed, match="relationships"):
        job.run(spark, shards(spark, three_days() + [orphan]), root)
    assert not tables.table_exists(spark, f"{root}/reports/daily_metrics")


def moved(row: dict, day: str) -> dict:
    """The event in the shard of another day."""
    return {**row, "source_table_suffix": day}


@pytest.mark.parametrize("first", [True, False])
def test_a_run_that_breaks_while_staging_is_made_good(spark, tmp_path, monkeypatch, first):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    if not first:
        job.run(spark, shards(spark, three_days()[:1]), step)
    fewer = [r for r in three_days() if r["user_pseudo_id"] != "v"]
    source = shards(spark, three_days())

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(staging, "users_of", broken)
        with pytest.raises(OSError):
            job.run(spark, source, step)
    assert job.run(spark, source, step) == {"days": []}
    job.run(spark, source, whole)
    assert stored(job.Warehouse(spark, step)) == stored(job.Warehouse(spark, whole))
    # a reload that takes rows away, broken in between, is followed as well
    with monkeypatch.context() as patch:
        patch.setattr(job, "stage", broken)
        with pytest.raises(OSError):
            job.run(spark, shards(spark, fewer), step, override="20240102")
    assert job.run(spark, shards(spark, fewer), step, override="20240103")["days"] == ["20240103"]
    again = str(tmp_path / "again")
    job.run(spark, shards(spark, fewer), again)
    assert stored(job.Warehouse(spark, step)) == stored(job.Warehouse(spark, again))


def test_events_dated_otherwise_than_their_shard(spark, tmp_path):
    late = moved(purchase("20240102", "w", "t9", items=ITEMS), "20240103")
    everything = three_days() + [late]
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    job.run(spark, shards(spark, three_days()[:4]), step)
    job.run(spark, shards(spark, everything), step)
    job.run(spark, shards(spark, everything), whole)
    expected = stored(job.Warehouse(spark, whole))
    assert stored(job.Warehouse(spark, step)) == expected
    for day in ("20240102", "20240103"):
        job.run(spark, shards(spark, everything), step, override=day)
        assert stored(job.Warehouse(spark, step)) == expected
    job.run(spark, shards(spark, three_days()), step, override="20240103")
    assert "t9" not in [r for (r,) in rows_of(job.Warehouse(spark, step).table("stg_purchases"), "transaction_id")]


def test_differing_copies_stop_the_reports(spark, tmp_path):
    twice = [purchase("20240101", "u", "t", revenue=x, items=ITEMS) for x in (10.0, 99.0)]
    with pytest.raises(quality.CheckFailed, match="differing stg_purchases.event_id: 1"):
        job.run(spark, shards(spark, twice + three_days()), str(tmp_path / "a"))
    same = [purchase("20240101", "u", "t")] * 2
    assert job.run(spark, shards(spark, same + three_days()), str(tmp_path / "b"))["days"]


def test_ledger_clock_in_another_zone(spark, tmp_path, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        job.run(spark, shards(spark, three_days()), str(tmp_path))
        began = job.Warehouse(spark, str(tmp_path)).ledger().agg(F.max(F.unix_seconds("started_at"))).first()[0]
        assert abs(began - time.time()) < 600
    finally:
        monkeypatch.undo()
        time.tzset()


def test_lookback_reaches_the_job(spark, tmp_path):
    root = str(tmp_path)
    job.run(spark, shards(spark, three_days()[:1] + three_days()[2:]), root)
    more = three_days() + [visit("20240101", "z", 3)]
    assert job.run(spark, shards(spark, more), root, lookback_days=3) == {"days": []}
    assert job.run(spark, shards(spark, more), root) == {"days": ["20240101", "20240102"]}


def test_days_to_stage(spark):
    at = lambda h: datetime(2024, 1, 9, h)
    rows = [
        ("1", date(2024, 1, 1), "raw", "success", 1, None, at(1), at(2), 0.0),
        ("2", date(2024, 1, 1), "staging", "success", 0, None, at(3), at(4), 0.0),
        ("3", date(2024, 1, 2), "raw", "failed", 0, None, at(1), at(4), 0.0),
        ("4", date(2024, 1, 2), "staging", "success", 0, None, at(3), at(5), 0.0),
        ("5", date(2024, 1, 3), "raw", "success", 1, None, at(1), at(2), 0.0),
        ("6", date(2024, 1, 3), "staging", "failed", 0, None, at(3), at(4), 0.0),
    ]
    runs = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in PIPELINE_RUNS.items()))
    assert discovery.day_list(discovery.days_to_stage(runs)) == ["20240102", "20240103"]


def test_events_of_one_row_group_are_dealt_over_tasks(spark, tmp_path):
    rows = [(k, k % 7, "purchase" if k % 2 else "view", 1.5, '{"k": 3}', datetime(2024, 1, 1 + k % 3)) for k in range(60)]
    flat = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string, ts timestamp_ntz")
    flat.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    whole, dealt = web_shards(spark, str(tmp_path)), web_shards(spark, str(tmp_path), spread=4)
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() == 4
    assert dealt.exceptAll(whole).isEmpty() and dealt.count() == whole.count() == 60
