"""Metrics, ranks, checks and reports."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from events import purchase, rows_of, shards, visit
from shopgauge.functions import dates, money
from shopgauge.operators import marts, quality, ranking, raw, reports, staging


def built(spark, rows):
    events = raw.raw_events(shards(spark, rows))
    days = marts.with_first_day(marts.customer_days(staging.purchases(events)))
    daily = marts.daily_metrics(days, staging.sessions(events))
    return daily, marts.weekly_metrics(daily, days)


def by_day(daily):
    return {r.date: r for r in daily.collect()}


def test_days_with_only_sessions_or_only_purchases(spark):
    daily, _ = built(spark, [visit("20240101", "u"), purchase("20240102", "u", "t")])
    days = by_day(daily)
    first, second = days[date(2024, 1, 1)], days[date(2024, 1, 2)]
    assert (first.sessions, first.total_orders, first.conversion_rate) == (1, 0, 0.0)
    assert first.gross_revenue == first.avg_order_value == 0.0
    assert (second.sessions, second.total_orders, second.conversion_rate) == (0, 1, None)
    shown = {r["Date"]: r["Conversion Rate (%)"] for r in reports.daily_report(daily).collect()}
    assert shown == {"2024-01-01": 0.0, "2024-01-02": 0.0}


def test_orders_are_events_not_transactions(spark):
    rows = [purchase("20240101", "u", "t"), purchase("20240101", "u", "t", time="14:00:00")]
    daily, _ = built(spark, rows)
    assert daily.first().total_orders == 2
    items = [
        dict(row, items=[{"item_id": "i", "item_name": "n", "quantity": 1}]) for row in rows
    ]
    staged = staging.purchase_items(raw.raw_purchase_items(shards(spark, items)))
    assert marts.product_metrics(marts.product_totals(staged)).first().total_orders == 1


def test_refund_without_revenue_fires_the_identity_check(spark):
    daily, _ = built(spark, [purchase("20240101", "u", "t", revenue=None, refund=4.0)])
    row = daily.first()
    assert (row.gross_revenue, row.refund_amount, row.net_revenue) == (0.0, 4.0, 0.0)
    assert quality.net_revenue_identity(daily).first().failing_rows == 1


def test_purchase_without_user_counts_as_order_only(spark):
    daily, weekly = built(spark, [purchase("20240101", None, "t"), purchase("20240101", "u", "s")])
    row = daily.first()
    assert (row.total_orders, row.unique_customers, row.new_customers) == (2, 1, 1)
    assert weekly.first().unique_customers == 1


def test_new_and_returning(spark):
    rows = [
        purchase("20240101", "u", "1"),
        purchase("20240101", "u", "2", time="15:00:00"),
        purchase("20240102", "u", "3"),
        purchase("20240102", "v", "4"),
    ]
    daily, weekly = built(spark, rows)
    got = rows_of(daily, "date", "unique_customers", "new_customers", "returning_customers")
    assert got == [(date(2024, 1, 1), 1, 1, 0), (date(2024, 1, 2), 2, 1, 1)]
    week = weekly.first()
    assert (week.unique_customers, week.new_customers, week.returning_customers) == (2, 2, 0)
    events = raw.raw_events(shards(spark, rows))
    orders = staging.purchases(events)
    joined = marts.new_vs_returning(orders, staging.users(events, orders))
    assert rows_of(joined) == got


def test_week_bounds(spark):
    rows = [(date(2021, 1, 3),), (date(2021, 1, 4),)]
    df = spark.createDataFrame(rows, "d date")
    monday = rows_of(df.select("d", dates.week_start("d")))
    assert monday == [(rows[0][0], date(2020, 12, 28)), (rows[1][0], date(2021, 1, 4))]
    sunday = rows_of(df.select("d", dates.week_start("d", "sunday")))
    assert sunday == [(rows[0][0], date(2021, 1, 3)), (rows[1][0], date(2021, 1, 3))]
    end = df.select(dates.week_end(dates.week_start("d"))).first()[0]
    assert end == date(2021, 1, 3)


def test_weekly_reconciles_and_detects(spark):
    rows = [purchase(f"2024010{d}", "u", str(d), revenue=0.1 * d) for d in range(1, 9)]
    daily, weekly = built(spark, rows)
    assert quality.weekly_reconciles(weekly, daily).first().failing_rows == 0
    off = weekly.withColumn("total_orders", F.col("total_orders") + 1)
    assert quality.weekly_reconciles(off, daily).first().failing_rows == 2
    cents = weekly.withColumn("gross_revenue", F.col("gross_revenue") + 0.02)
    assert quality.weekly_reconciles(cents, daily).first().failing_rows == 2


def test_checks_find_bad_rows(spark):
    daily = spark.createDataFrame(
        [(date(2024, 1, 1), 1, 2, -0.5), (date(2024, 1, 2), 2, 2, None)],
        "date date, total_orders bigint, new_customers bigint, conversion_rate double",
    )
    assert quality.new_customers_within_orders(daily).first().failing_rows == 1
    assert quality.rate_non_negative(daily).first().failing_rows == 1
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows_of(quality.unique("t", keys, "k")) == [("unique t.k", 1)]
    assert rows_of(quality.not_null("t", keys, ["k"])) == [("not_null t.k", 2)]
    parents = spark.createDataFrame([("b",)], "k string")
    orphans = quality.relationships("fk", keys, "k", parents, "k")
    assert rows_of(orphans) == [("fk", 2)]
    with pytest.raises(quality.CheckFailed, match="fk: 2"):
        quality.gate(orphans)


def test_empty_input_gives_empty_marts(spark):
    daily, weekly = built(spark, [])
    assert daily.count() == weekly.count() == 0
    items = staging.purchase_items(raw.raw_purchase_items(shards(spark, [])))
    assert marts.product_metrics(marts.product_totals(items)).count() == 0


@pytest.mark.parametrize(
    "value, places, wanted",
    [(2.345, 2, 2.35), (-2.345, 2, -2.35), (0.00005, 4, 0.0001), (0.0, 2, 0.0), (7.0, 2, 7.0)],
)
def test_rounding(spark, value, places, wanted):
    assert spark.range(1).select(money.round_half_up(F.lit(value), places)).first()[0] == wanted


def _ranked_as_window(df):
    plain = F.rank().over(Window.orderBy(F.col("v").desc())).cast("bigint")
    return rows_of(df.select("id", "v", plain.alias("r")))


@pytest.mark.parametrize(
    "values",
    [
        "id",  # all different
        "id % 3",  # few heavy values
        "IF(id % 3 = 0, 0, id)",  # a third tied
        "IF(id % 3 = 0, NULL, id DIV 7)",  # a third missing
        "CAST(NULL AS bigint)",
        "CAST(sqrt(id) * 1000 AS decimal(20,6))",
    ],
)
def test_global_rank_equals_plain_rank(spark, values):
    df = spark.range(3000).selectExpr("id", f"{values} AS v")
    ours = ranking.global_ranks(df, {"r": "v"})
    assert rows_of(ours) == _ranked_as_window(df)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers()), max_size=30))
def test_global_rank_property(spark, values):
    values = [v if v is None else max(min(v, 2**62), -(2**62)) for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    assert rows_of(ranking.global_ranks(df, {"r": "v"})) == _ranked_as_window(df)


def test_top_products_break_ties_by_name(spark):
    items = [{"item_id": str(i), "item_name": f"n{i:02d}", "quantity": 1} for i in range(30)]
    rows = [purchase("20240101", "u", "t", items=items)]
    staged = staging.purchase_items(raw.raw_purchase_items(shards(spark, rows)))
    top = reports.top_products_by_quantity(marts.product_metrics(marts.product_totals(staged))).collect()
    assert [r["Product"] for r in top] == [f"n{i:02d}" for i in range(20)]
    assert {r["Quantity Rank"] for r in top} == {1}
