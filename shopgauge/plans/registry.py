"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_suffix
from ..functions.params import has_params
from ..operators import discovery, incremental, marts, quality, raw, reports, staging
from ..schemas import PIPELINE_RUNS, RAW_EVENTS, RAW_PURCHASE_ITEMS
from ..session import scratch_path, store
from ..sources import snapshots, tables
from ..sources.driver_tables import order_shards, web_shards
from ..sources.shards import SUFFIX, in_range, shard_dates, shard_row_counts
from . import job

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and instants as microseconds, the same for every client."""

    shown = {"date": "CAST({0} AS string) AS {0}", "timestamp": "unix_micros({0}) AS {0}"}
    return df.selectExpr(*[shown.get(kind, "{0}").format(f"`{name}`") for name, kind in df.dtypes])


# --- inputs -----------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str, event_name: str | None = None) -> DataFrame:
    return raw.raw_events(web_shards(spark, sf_dir, event_name))


def _stored_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards that are about to be stored, dealt over all cores: a task for each row group would sort and write few wide files one after the other."""
    return web_shards(spark, sf_dir, spread=spark.sparkContext.defaultParallelism)


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.purchases(_events(spark, sf_dir, "purchase"))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.sessions(_events(spark, sf_dir, "session_start"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.users(_events(spark, sf_dir, "session_start"), _purchases(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines, dealt over all cores: the given file is one row group, that is one task."""
    return order_shards(spark, sf_dir, spread=spark.sparkContext.defaultParallelism)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.purchase_items(raw.raw_purchase_items(_orders(spark, sf_dir)))


def _customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.with_first_day(marts.customer_days(_purchases(spark, sf_dir)))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_metrics(_customer_days(spark, sf_dir), _sessions(spark, sf_dir))


def _daily_and_weekly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both marts; the customer days they share are computed once."""
    days = store(_customer_days(spark, sf_dir), "customer_days")
    daily = store(marts.daily_metrics(days, _sessions(spark, sf_dir)), "daily")
    return daily, marts.weekly_metrics(daily, days)


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = store(_customer_days(spark, sf_dir), "customer_days")
    return marts.weekly_metrics(marts.daily_metrics(days, _sessions(spark, sf_dir)), days)


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(marts.product_totals(_items(spark, sf_dir)), "product_totals")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_metrics(_totals(spark, sf_dir))


def _day_of_month(column: str) -> Column:
    return F.dayofmonth(parse_suffix(column))


def _raw_copy(shards: DataFrame) -> DataFrame:
    """Shards as an earlier load left them: day 5 absent, day 7 with events missing."""
    day = _day_of_month(SUFFIX)
    lost = (day == 5) | ((day == 7) & (F.col("event_timestamp") % 10 == 0))
    return shards.where(~lost)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of each day, every seventh of which failed; day 14 succeeded later on."""
    shards = web_shards(spark, sf_dir)
    loaded = (
        shard_row_counts(shards, "rows_processed")
        .union(shard_row_counts(raw.raw_purchase_items(shards), "rows_processed"))
        .groupBy("date_suffix")
        .agg(F.sum("rows_processed").alias("rows_processed"))
    )
    attempts = F.when(
        _day_of_month("date_suffix") == 14, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    tries = loaded.select("*", F.explode(attempts).alias("attempt"))
    day = _day_of_month("date_suffix")
    failed = (day % 7 == 0) & (F.col("attempt") == 0)
    began = parse_suffix("date_suffix").cast("timestamp") + F.make_dt_interval(
        hours=F.col("attempt") + 6
    )
    return discovery.ledger_runs(
        tries,
        F.when(failed, "failed").otherwise("success"),
        F.when(failed, F.concat(F.lit("no shard "), F.col("date_suffix"))),
        began,
        began + F.make_dt_interval(mins=day % 5 + 1),
    )


# --- load -------------------------------------------------------------------


def raw_events_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw events, with the nested columns shown by some of their leaves."""
    return _events(spark, sf_dir).select(
        "event_date_dt",
        "event_id",
        "event_name",
        "event_timestamp",
        "event_bundle_sequence_id",
        "user_pseudo_id",
        "user_id",
        "user_first_touch_timestamp",
        F.array_join(F.transform("event_params", lambda p: p["key"]), ",").alias("param_keys"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_in_usd"),
        F.col("ecommerce.refund_value_in_usd").alias("refund_value_in_usd"),
        F.col("traffic_source.source").alias("source"),
        F.col("device.category").alias("device_category"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("geo.country").alias("country"),
        F.col("user_ltv.revenue").alias("ltv_revenue"),
        "platform",
        "stream_id",
        F.col("privacy_info.analytics_storage").alias("analytics_storage"),
        F.col("app_info.id").alias("app_id"),
        F.col("event_dimensions.hostname").alias("hostname"),
        SUFFIX,
    )


def raw_purchase_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.raw_purchase_items(_orders(spark, sf_dir)).drop("ingested_at")


def raw_reload_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw tables after the days that were absent or incomplete are reloaded."""
    shards = _stored_shards(spark, sf_dir)
    earlier = _raw_copy(shards)
    events, items = scratch_path(spark, "raw_events"), scratch_path(spark, "raw_purchase_items")
    tables.create_if_absent(spark, events, RAW_EVENTS)
    tables.create_if_absent(spark, items, RAW_PURCHASE_ITEMS)
    tables.reload_days(raw.raw_events(earlier), events, cluster_by=job.EVENT_ORDER)
    tables.reload_days(raw.raw_purchase_items(earlier), items)
    stored = tables.read_table(spark, events, RAW_EVENTS)
    days = discovery.day_list(discovery.incomplete_dates(shards, stored))
    tables.reload_days(raw.raw_events(shards), events, days, cluster_by=job.EVENT_ORDER)
    tables.reload_days(raw.raw_purchase_items(shards), items, days)
    per_event_day = (
        tables.read_table(spark, events, RAW_EVENTS)
        .groupBy(F.col(SUFFIX).alias("date_suffix"))
        .agg(
            F.count("*").alias("event_rows"),
            F.min("event_id").alias("first_event_id"),
            F.max("event_id").alias("last_event_id"),
        )
    )
    item_rows = shard_row_counts(tables.read_table(spark, items, RAW_PURCHASE_ITEMS), "item_rows")
    return per_event_day.join(item_rows, "date_suffix", "left")


def one_day_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days reloaded one by one after a backfill without day 5 and parts of day 7.

    Day 5 comes in, day 9 has become empty, and day 11, whose dates can't be
    read, fails and keeps its rows. Each day with its rows and its last load.
    """
    day = _day_of_month(SUFFIX)
    shards = _stored_shards(spark, sf_dir)
    wh = job.Warehouse(spark, scratch_path(spark, "reload"))
    wh.ensure_raw()
    earlier = _raw_copy(shards)
    job.backfill(wh, earlier, discovery.day_list(shard_dates(earlier)))
    spoilt = F.when(day == 11, F.lit("no date")).otherwise(F.col("event_date"))
    now = shards.where(day != 9).withColumn("event_date", spoilt)
    three = shard_dates(shards).where(_day_of_month("date_suffix").isin(5, 9, 11))
    job.load_each(wh, now, discovery.day_list(three))
    loads = wh.ledger().groupBy(F.date_format("run_date", "yyyyMMdd").alias("date_suffix")).agg(
        F.count("*").alias("loads"),
        F.max_by("status", "started_at").alias("last_status"),
        F.max_by("rows_processed", "started_at").alias("last_rows"),
    )
    rows = shard_row_counts(wh.events(), "event_rows")
    return loads.join(rows, "date_suffix", "left").withColumn("event_rows", F.coalesce("event_rows", F.lit(0)))


def late_days_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily mart after late days were loaded, staged by their indexes and followed day by day."""
    shards = _stored_shards(spark, sf_dir)
    earlier = _raw_copy(shards)
    wh = job.Warehouse(spark, scratch_path(spark, "late"))
    wh.ensure_raw()
    job.backfill(wh, earlier, discovery.day_list(shard_dates(earlier)))
    job.stage(wh, None)
    job.build_marts(wh)
    days = discovery.day_list(discovery.incomplete_dates(shards, wh.events()))
    job.load_each(wh, shards, days)
    job.stage(wh, days)
    job.build_marts(wh)
    return wh.table("mart_daily_metrics")


def completed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.completed_dates(_ledger(spark, sf_dir))


def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.missing_dates(web_shards(spark, sf_dir), _ledger(spark, sf_dir))


def incomplete_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = web_shards(spark, sf_dir)
    return discovery.incomplete_dates(shards, _raw_copy(shards))


def dates_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = web_shards(spark, sf_dir)
    return discovery.dates_to_process(shards, _raw_copy(shards), _ledger(spark, sf_dir))


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as appended to and read back."""
    path = scratch_path(spark, "pipeline_runs")
    tables.create_if_absent(spark, path, PIPELINE_RUNS)
    tables.append_runs(_ledger(spark, sf_dir), path)
    return tables.read_table(spark, path, PIPELINE_RUNS).select(
        "run_date", "layer", "status", "rows_processed", "error_message", "duration_seconds"
    )


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(spark, sf_dir)
    last = ledger.agg(F.max("started_at").alias("t")).first()["t"]
    return discovery.recent_runs(ledger, F.lit(last))


def row_count_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.row_count_anomaly(_ledger(spark, sf_dir), tolerance=0.01)


# --- staging ----------------------------------------------------------------


def event_param_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {**staging.SESSION_PARAMS, **staging.PURCHASE_PARAMS}
    events = _events(spark, sf_dir).where(has_params())
    return staging.pivot_params(events, wanted).select("event_id", *wanted)


def landing_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.landing_attributes(_events(spark, sf_dir, "session_start"))


def first_touch_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.first_touch_attributes(_events(spark, sf_dir, "session_start"))


def first_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.first_purchase(_purchases(spark, sf_dir))


def user_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.user_universe(
        _events(spark, sf_dir, "session_start"), _purchases(spark, sf_dir)
    )


# --- incremental ------------------------------------------------------------


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the days that a target built up to the end of 1998 does not have."""
    items = _items(spark, sf_dir)
    target = items.where(F.col("purchase_date") <= F.lit("1998-12-31").cast("date"))
    return incremental.after_watermark(items, target, "purchase_date", "purchase_date").select(
        "item_event_id", "purchase_date", "item_revenue_usd"
    )


def _delivery(purchases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchases up to day 15, and a delivery of the rest with day 10 corrected."""
    day = F.dayofmonth("purchase_date")
    revenue = F.when(day == 10, F.col("revenue_usd") + 1).otherwise(F.col("revenue_usd"))
    return (
        purchases.where(day <= 15),
        purchases.where((day > 15) | (day == 10)).withColumn("revenue_usd", revenue),
    )


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of purchases after a delivery was merged into it by key."""
    target, batch = _delivery(store(_purchases(spark, sf_dir), "purchases"))
    path = scratch_path(spark, "merged_purchases")
    tables.rebuild_by_day(target, path, "purchase_date")
    tables.merge_by_key(batch, path, "event_id", "purchase_date")
    return snapshots.read(spark, path, batch.schema).select(
        "event_id", "purchase_date", "transaction_id", "revenue_usd"
    )


def users_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users merged from what was stored of each day, after late days replaced theirs."""
    complete = _events(spark, sf_dir, "session_start")
    earlier = _raw_copy(complete)
    path = scratch_path(spark, "user_visits")
    visits = staging.user_visits(complete, SUFFIX)
    tables.rebuild_by_day(staging.user_visits(earlier, SUFFIX), path, SUFFIX)
    tables.reload_days(visits, path, discovery.day_list(discovery.incomplete_dates(complete, earlier)))
    return staging.users_of(snapshots.read(spark, path, visits.schema), _purchases(spark, sf_dir))


def products_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from sums and orders per day, from one pass over the items."""
    items = store(
        _items(spark, sf_dir).select(
            "item_name", "item_id", "transaction_id", "purchase_date", "category_l1", "category_l2",
            "item_revenue_usd", "item_refund_usd", "quantity", "price_in_usd",
        ),
        "items",
    )
    days, orders = store(marts.product_days(items), "product_days"), marts.product_orders(items)
    return marts.product_metrics(store(marts.product_totals_of(days, orders), "product_totals"))


def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into an older table that lacks the city and has a column since removed."""
    target, batch = _delivery(store(_purchases(spark, sf_dir), "purchases"))
    older = target.drop("city").withColumn("campaign_code", F.lit("old"))
    return incremental.upsert(older, batch, "event_id").select(
        "event_id", "purchase_date", "country", "city", "revenue_usd"
    )


def session_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions after late events arrive, rebuilt only where a session was touched."""
    complete = _events(spark, sf_dir, "session_start")
    earlier = _raw_copy(complete)
    days = discovery.day_list(discovery.incomplete_dates(complete, earlier))
    touched = incremental.touched_sessions(earlier, days).union(
        incremental.touched_sessions(complete, days)
    )
    stored = store(touched.distinct(), "touched_sessions")
    return incremental.refresh_sessions(staging.sessions(earlier), complete, stored)


# --- marts and reports ------------------------------------------------------


def new_vs_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = store(_purchases(spark, sf_dir), "purchases")
    users = staging.users(_events(spark, sf_dir, "session_start"), bought)
    return marts.new_vs_returning(bought, users)


def weekly_unique_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.weekly_unique_customers(marts.customer_days(_purchases(spark, sf_dir)))


def report_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_report(_daily(spark, sf_dir))


def report_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.weekly_report(_weekly(spark, sf_dir))


def top_products_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = marts.top_product_metrics(_totals(spark, sf_dir), "revenue_rank", reports.TOP)
    return reports.top_products_by_revenue(best)


def top_products_by_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = marts.top_product_metrics(_totals(spark, sf_dir), "quantity_rank", reports.TOP)
    return reports.top_products_by_quantity(best)


# --- checks -----------------------------------------------------------------


def _checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables the checks read, each built once from the web shards."""
    sessions = store(_sessions(spark, sf_dir), "sessions")
    purchases = store(_purchases(spark, sf_dir), "purchases")
    items = staging.purchase_items(raw.raw_purchase_items(web_shards(spark, sf_dir, "purchase")))
    days = store(marts.with_first_day(marts.customer_days(purchases)), "customer_days")
    daily = store(marts.daily_metrics(days, sessions), "daily")
    return {
        "stg_sessions": sessions,
        "stg_purchases": purchases,
        "stg_purchase_items": items,
        "stg_users": staging.users(_events(spark, sf_dir, "session_start"), purchases),
        "mart_daily_metrics": daily,
        "mart_weekly_metrics": marts.weekly_metrics(daily, days),
        "mart_product_metrics": marts.product_totals(items),
    }


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _checked_tables(spark, sf_dir)
    return quality.combine(
        [quality.table_checks(name, built[name], key) for name, key in job.UNIQUE_KEYS.items()]
    )


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _checked_tables(spark, sf_dir)
    return quality.combine(
        [quality.table_checks(name, built[name], None, cols) for name, cols in job.REQUIRED.items()]
    )


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = _orders(spark, sf_dir)
    return quality.relationships(
        "relationships stg_purchase_items.event_id",
        staging.purchase_items(raw.raw_purchase_items(shards)),
        "event_id",
        staging.purchases(raw.raw_events(shards)),
        "event_id",
    )


def dq_net_revenue_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.net_revenue_identity(_daily(spark, sf_dir))


def dq_new_le_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.new_customers_within_orders(_daily(spark, sf_dir))


def dq_rate_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_non_negative(_daily(spark, sf_dir))


def dq_weekly_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, weekly = _daily_and_weekly(spark, sf_dir)
    return quality.weekly_reconciles(weekly, daily)


def dq_source_vs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = web_shards(spark, sf_dir)
    return quality.source_vs_raw(shards, _raw_copy(shards))


def _delivered_again(events: DataFrame) -> DataFrame:
    """Events of which some come twice, and some a second time with another revenue."""
    stamp = F.col("event_timestamp")
    more = F.col("ecommerce.purchase_revenue_in_usd") + 1
    changed = events.where(stamp % 17 == 0).withColumn(
        "ecommerce", F.col("ecommerce").withField("purchase_revenue_in_usd", more)
    )
    return events.unionByName(events.where(stamp % 13 == 0)).unionByName(changed)


def purchase_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of which some were delivered again: one row each, of the smallest values."""
    again = _delivered_again(_events(spark, sf_dir, "purchase"))
    return staging.purchases(again).select("event_id", "transaction_id", "revenue_usd")


def dq_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = _delivered_again(_events(spark, sf_dir, "purchase"))
    return quality.collapsed_purchases(staging.purchase_events(again))


def purchase_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases after late shards arrive, some events lying in the next day's shard.

    The dates that the reloaded shards held and hold are rebuilt from all shards.
    """
    next_day = F.date_format(F.date_add(parse_suffix(SUFFIX), 1), "yyyyMMdd")
    moved = F.when(F.col("event_timestamp") % 10 == 3, next_day).otherwise(F.col(SUFFIX))
    shards = web_shards(spark, sf_dir, "purchase").withColumn(SUFFIX, moved)
    before, after = raw.raw_events(_raw_copy(shards)), raw.raw_events(shards)
    days = discovery.day_list(discovery.incomplete_dates(shards, before))
    touched = incremental.purchase_dates(before, days).union(incremental.purchase_dates(after, days))
    dates = [row[0] for row in touched.distinct().collect()]  # one per day
    rebuilt = staging.purchases(after.where(F.col("event_date_dt").isin(dates)))
    fresh = incremental.replace_days(staging.purchases(before), rebuilt, "purchase_date", dates)
    return fresh.select("purchase_date", "event_timestamp", "user_pseudo_id", "transaction_id", "revenue_usd")


def days_to_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days not staged since their last load: two of three were staged half an hour after the first."""
    loads = store(_ledger(spark, sf_dir), "ledger")
    day = F.dayofmonth("run_date")
    began = F.col("run_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(6), mins=F.lit(30))
    staged = (
        loads.where(day % 3 != 0)
        .withColumn("layer", F.lit("staging"))
        .withColumn("status", F.lit("success"))
        .withColumn("started_at", began)
        .withColumn("completed_at", began)
    )
    return discovery.days_to_stage(loads.unionByName(staged))


def shard_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of the days 10 to 19 of the month that the events are from."""
    shards = web_shards(spark, sf_dir)
    month = shards.agg(F.min(SUFFIX)).first()[0][:6]
    return shard_row_counts(in_range(shards, f"{month}10", f"{month}19"))


def published_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report as written and read back."""
    report = reports.daily_report(_daily(spark, sf_dir))
    path = scratch_path(spark, "daily_report")
    tables.write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of the tables with planted faults."""
    try:
        quality.gate(dq_planted_faults(spark, sf_dir))
        said = None
    except quality.CheckFailed as problem:
        said = str(problem)
    return spark.createDataFrame([(said is None, said)], "passed boolean, failing string")


def dq_planted_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks over tables with faults planted on certain days."""
    sessions = store(_sessions(spark, sf_dir), "sessions")
    days = store(_customer_days(spark, sf_dir), "customer_days")
    daily = store(marts.daily_metrics(days, sessions), "daily")
    weekly = marts.weekly_metrics(daily, days)
    start, day = F.dayofmonth("session_date"), F.dayofmonth("date")

    def planted(df: DataFrame, where: Column, column: str, value: Column) -> DataFrame:
        return df.withColumn(column, F.when(where, value).otherwise(F.col(column)))

    more = F.col("total_orders") + 1
    off = F.col("gross_revenue") + 0.02
    no_user = F.lit(None).cast("string")
    return quality.combine(
        [
            quality.unique("stg_sessions", sessions.unionByName(sessions.where(start == 3)), "session_key"),
            quality.not_null("stg_sessions", planted(sessions, start == 4, "user_pseudo_id", no_user), ["user_pseudo_id"]),
            quality.net_revenue_identity(planted(daily, day % 5 == 0, "net_revenue", F.col("net_revenue") + 0.02)),
            quality.new_customers_within_orders(planted(daily, day % 4 == 0, "new_customers", more)),
            quality.rate_non_negative(planted(daily, day % 7 == 0, "conversion_rate", F.lit(-0.1))),
            quality.weekly_reconciles(planted(weekly, F.dayofmonth("week_start") % 2 == 0, "gross_revenue", off), daily),
        ]
    )


# --- the list ---------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "raw_events_load": raw_events_load,
    "raw_purchase_items": raw_purchase_items,
    "shard_dates": lambda spark, sf: shard_dates(web_shards(spark, sf)),
    "shard_row_counts": lambda spark, sf: shard_row_counts(web_shards(spark, sf)),
    "completed_dates": completed_dates,
    "missing_dates": missing_dates,
    "incomplete_dates": incomplete_dates,
    "dates_to_process": dates_to_process,
    "raw_reload_day": raw_reload_day,
    "one_day_reload": one_day_reload,
    "late_days_daily": late_days_daily,
    "run_ledger": run_ledger,
    "recent_runs": recent_runs,
    "row_count_anomaly": row_count_anomaly,
    "event_param_pivot": event_param_pivot,
    "landing_attributes": landing_attributes,
    "first_touch_attributes": first_touch_attributes,
    "first_purchase": first_purchase,
    "user_universe": user_universe,
    "stg_sessions": _sessions,
    "stg_purchases": _purchases,
    "stg_purchase_items": _items,
    "stg_users": _users,
    "incremental_filter": incremental_filter,
    "keyed_upsert": keyed_upsert,
    "users_from_days": users_from_days,
    "products_from_days": products_from_days,
    "schema_sync": schema_sync,
    "session_refresh": session_refresh,
    "new_vs_returning": new_vs_returning,
    "weekly_unique_customers": weekly_unique_customers,
    "mart_daily_metrics": _daily,
    "mart_weekly_metrics": _weekly,
    "mart_product_metrics": _products,
    "report_daily": report_daily,
    "report_weekly": report_weekly,
    "top_products_by_revenue": top_products_by_revenue,
    "top_products_by_quantity": top_products_by_quantity,
    "published_report": published_report,
    "gate_verdict": gate_verdict,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_relationships": dq_relationships,
    "dq_net_revenue_identity": dq_net_revenue_identity,
    "dq_new_le_orders": dq_new_le_orders,
    "dq_rate_non_negative": dq_rate_non_negative,
    "dq_weekly_reconciles": dq_weekly_reconciles,
    "dq_source_vs_raw": dq_source_vs_raw,
    "dq_collapsed": dq_collapsed,
    "dq_planted_faults": dq_planted_faults,
    "purchase_redelivery": purchase_redelivery,
    "purchase_refresh": purchase_refresh,
    "days_to_stage": days_to_stage,
    "shard_range_counts": shard_range_counts,
}


def _with_portable(query: Query) -> Query:
    return lambda spark, sf_dir: portable(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _with_portable(query) for name, query in QUERIES.items()}
