"""The whole run: load raw days, refresh staging, rebuild marts, check, report."""

from __future__ import annotations

import logging
import os
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import discovery, incremental, marts, quality, raw, reports, staging
from ..schemas import PIPELINE_RUNS, RAW_EVENTS, RAW_PURCHASE_ITEMS, ddl
from ..session import store
from ..sources import snapshots, tables
from ..sources.shards import SUFFIX, one_shard, shard_dates, shard_row_counts

log = logging.getLogger(__name__)

EVENT_ORDER = ("event_name", "user_pseudo_id")
REPORT_BUILDERS = {
    "daily_metrics": ("mart_daily_metrics", reports.daily_report),
    "weekly_metrics": ("mart_weekly_metrics", reports.weekly_report),
    "top_products_by_revenue": ("mart_product_metrics", reports.top_products_by_revenue),
    "top_products_by_quantity": ("mart_product_metrics", reports.top_products_by_quantity),
}


# Tables stored by day: how each is built whole, and its day column.
STAGED_BY_DAY = {
    "stg_sessions": (lambda wh: staging.sessions(wh.events()), "session_date"),
    "stg_purchases": (lambda wh: staging.purchases(wh.events()), "purchase_date"),
    "stg_purchase_items": (lambda wh: staging.purchase_items(wh.items()), "purchase_date"),
}
# What later runs need to know of shards without opening them again, by shard day.
OF_SHARDS = {
    "session_days": (lambda wh: incremental.session_days(wh.events()), SUFFIX),
    "event_days": (lambda wh: incremental.event_days(wh.events(), wh.items()), SUFFIX),
    "user_visits": (lambda wh: staging.user_visits(wh.events(), SUFFIX), SUFFIX),
}
# Sums and orders of products, which their totals are made from.
OF_ITEMS = {
    "product_days": (lambda wh: marts.product_days(wh.table("stg_purchase_items")), "purchase_date"),
    "product_orders": (lambda wh: marts.product_orders(wh.table("stg_purchase_items")), "purchase_date"),
}
BY_DAY = {**STAGED_BY_DAY, **OF_SHARDS, **OF_ITEMS}

# Days whose marts are behind the staging tables.
MART_DAYS = {"date": "date"}


class Warehouse:
    """Tables below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._schemas: dict = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def events(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("raw_events"), RAW_EVENTS)

    def items(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("raw_purchase_items"), RAW_PURCHASE_ITEMS)

    def ledger(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("pipeline_runs"), PIPELINE_RUNS)

    def mart_days(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("mart_days"), MART_DAYS)

    def table(self, name: str) -> DataFrame:
        """A staging, state or mart table. Those by day are read by the columns
        their builder declares, so that one without any day is readable too."""
        if name in BY_DAY and name not in self._schemas:
            self._schemas[name] = BY_DAY[name][0](self).schema
        return snapshots.read(self.spark, self.path(name), self._schemas.get(name))

    def ensure_raw(self) -> None:
        for name in ("raw_events", "raw_purchase_items", "pipeline_runs", "mart_days"):
            snapshots.create(self.spark, self.path(name))

    def staged(self) -> bool:
        """False until every table that is kept up by days has been built once."""
        return all(snapshots.exists(self.spark, self.path(name)) for name in [*BY_DAY, "stg_users"])

    def tidy(self) -> None:
        """Join the ledger's many small files, and drop what no reader goes by any more."""
        snapshots.compact(self.spark, self.path("pipeline_runs"), ddl(PIPELINE_RUNS))
        stored = ["raw_events", "raw_purchase_items", "pipeline_runs", "mart_days", *BY_DAY, "stg_users", *MARTS]
        for name in stored:
            snapshots.expire(self.spark, self.path(name))


MARTS = ("mart_daily_metrics", "mart_weekly_metrics", "mart_product_metrics")


def _date(suffix: str) -> date:
    return datetime.strptime(suffix, "%Y%m%d").date()


def _now() -> datetime:
    """The instant, with its zone: Spark would read one without in the driver's own zone."""
    return datetime.now(timezone.utc)


def load_day(wh: Warehouse, shards: DataFrame, day: str) -> int:
    """Reload one day of both raw tables; returns the rows the day now has."""
    one = one_shard(shards, day)
    tables.reload_day(
        raw.raw_events(one), wh.path("raw_events"), day, cluster_by=EVENT_ORDER
    )
    tables.reload_day(raw.raw_purchase_items(one), wh.path("raw_purchase_items"), day)
    return sum(one_shard(table, day).count() for table in (wh.events(), wh.items()))


def load_each(wh: Warehouse, shards: DataFrame, days: list[str]) -> list[str]:
    """Load day by day; returns the days that failed.

    A failure is recorded in the ledger and does not stop the other days.
    """
    failed = []
    for day in days:
        began, error, rows = _now(), None, 0
        try:
            rows = load_day(wh, shards, day)
        except Exception as problem:  # recorded in the ledger, reported by the caller
            error = str(problem)
            failed.append(day)
            log.error("day %s failed: %s", day, error)
        _record(wh, day, "failed" if error else "success", rows, error, began)
    return failed


def _record(wh: Warehouse, day: str, status: str, rows: int, error: str | None, began) -> None:
    try:
        loaded = wh.spark.createDataFrame([(day, rows)], "date_suffix string, rows_processed bigint")
        runs = discovery.ledger_runs(
            loaded, F.lit(status), F.lit(error).cast("string"), F.lit(began), F.lit(_now())
        )
        tables.append_runs(runs, wh.path("pipeline_runs"))
    except Exception as problem:  # the load itself stands
        log.warning("run of %s not recorded: %s", day, problem)


def backfill(wh: Warehouse, shards: DataFrame, days: list[str]) -> None:
    """Load many days with one write per raw table and record them together.

    Shards are stored by day, so the write needs no shuffle.
    """
    began = F.lit(_now())
    wanted = shards.where(F.col(SUFFIX).isin(days))
    events, items = raw.raw_events(wanted), raw.raw_purchase_items(wanted)
    tables.reload_days(
        events, wh.path("raw_events"), days, cluster_by=EVENT_ORDER, by_day_already=True
    )
    tables.reload_days(items, wh.path("raw_purchase_items"), days, by_day_already=True)
    loaded = (
        shard_row_counts(wh.events(), "rows_processed")
        .union(shard_row_counts(wh.items(), "rows_processed"))
        .where(F.col("date_suffix").isin(days))
        .groupBy("date_suffix")
        .agg(F.sum("rows_processed").alias("rows_processed"))
    )
    runs = discovery.ledger_runs(
        loaded, F.lit("success"), F.lit(None).cast("string"), began, F.lit(_now())
    )
    tables.append_runs(runs, wh.path("pipeline_runs"))


def stage(wh: Warehouse, days: list[str] | None) -> None:
    """Bring the staging tables up to date with reloaded days; None builds them whole.

    The ledger then says that the days are staged.
    """
    began = _now()
    if days is None:
        staged = shard_dates(wh.events()).union(discovery.days_to_stage(wh.ledger())).distinct()
        _stage_all(wh)
    else:
        staged = wh.spark.createDataFrame([(day,) for day in days], "date_suffix string")
        _stage_days(wh, days)
    done = discovery.ledger_runs(
        staged.withColumn("rows_processed", F.lit(0)),
        F.lit("success"),
        F.lit(None).cast("string"),
        F.lit(began),
        F.lit(_now()),
        layer="staging",
    )
    tables.append_runs(done, wh.path("pipeline_runs"))


def _stage_all(wh: Warehouse) -> None:
    for name, (build, column) in BY_DAY.items():
        tables.rebuild_by_day(build(wh), wh.path(name), column)
    users = staging.users_of(wh.table("user_visits"), wh.table("stg_purchases"))
    tables.rebuild(users, wh.path("stg_users"))


def _stage_days(wh: Warehouse, days: list[str]) -> None:
    """Follow reloaded days without opening other shards than those their sessions and dates lie in.

    What a day held before its reload is still in the tables of ``OF_SHARDS``,
    which are brought up to date last: a run that breaks in between leaves the
    next one all it needs. Purchases and items are stored by the date of the
    event, which may differ from the day of the shard, so the dates that the
    days hold, or held before, are rebuilt from all shards that have them.
    """
    spark, on_days = wh.spark, F.col(SUFFIX).isin(days)
    events, items = wh.events(), wh.items()
    fresh = {
        "session_days": store(incremental.session_days(events.where(on_days)), "session_days"),
        "event_days": store(incremental.event_days(events.where(on_days), items.where(on_days)), "event_days"),
        "user_visits": store(staging.user_visits(events.where(on_days), SUFFIX), "user_visits"),
    }

    def before_and_after(name: str, column: str) -> DataFrame:
        old = wh.table(name).where(on_days).select(column)
        return old.union(fresh[name].select(column)).distinct()

    dates = [row[0] for row in before_and_after("event_days", "event_date_dt").collect()]  # one per day
    _note_mart_days(wh, dates)
    held = _shards_of(wh, fresh, days, dates)
    on_dates = F.col("event_date_dt").isin(dates) & F.col(SUFFIX).isin(held)
    tables.reload_days(staging.purchases(events.where(on_dates)), wh.path("stg_purchases"), dates, "purchase_date")
    tables.reload_days(staging.purchase_items(items.where(on_dates)), wh.path("stg_purchase_items"), dates, "purchase_date")
    sold = wh.table("stg_purchase_items").where(F.col("purchase_date").isin(dates))
    tables.reload_days(marts.product_days(sold), wh.path("product_days"), dates, "purchase_date")
    tables.reload_days(marts.product_orders(sold), wh.path("product_orders"), dates, "purchase_date")

    touched = store(before_and_after("session_days", "session_key"), "touched")
    index = wh.table("session_days").where(~on_days).unionByName(fresh["session_days"])
    sessions = store(incremental.rebuild_sessions(events, touched, index), "rebuilt_sessions")
    moved = wh.table("stg_sessions").select("session_key", "session_date").join(touched, "session_key", "left_semi")
    starts = moved.select("session_date").union(sessions.select("session_date")).distinct().collect()  # one per day
    _note_mart_days(wh, [row[0] for row in starts])
    tables.merge_by_key(sessions, wh.path("stg_sessions"), "session_key", "session_date", touched)

    visits = wh.table("user_visits").where(~on_days).unionByName(fresh["user_visits"])
    users = store(staging.users_of(visits, wh.table("stg_purchases")), "users")
    _note_mart_days(wh, [row[0] for row in staging.moved_first_purchases(wh.table("stg_users"), users).collect()])  # days
    tables.rebuild(users, wh.path("stg_users"))
    for name, rows in fresh.items():
        tables.reload_days(rows, wh.path(name), days)


def _shards_of(wh: Warehouse, fresh: dict[str, DataFrame], days: list[str], dates: list) -> list[str]:
    """The days of the shards in which events of the given dates lie."""
    index = wh.table("event_days").where(~F.col(SUFFIX).isin(days)).unionByName(fresh["event_days"])
    held = index.where(F.col("event_date_dt").isin(dates)).select(SUFFIX).distinct()
    return [row[0] for row in held.collect()]  # one per day


def _note_mart_days(wh: Warehouse, dates: list) -> None:
    """Keep which days the marts have to follow, until they have."""
    if dates:
        rows = wh.spark.createDataFrame([(day,) for day in dates], "date date")
        snapshots.append(rows, wh.path("mart_days"))


def build_marts(wh: Warehouse) -> None:
    """Bring the marts up to date: whole the first time, then the days noted and their weeks."""
    noted = sorted({row["date"] for row in wh.mart_days().collect()} - {None})  # days of the calendar
    built = all(snapshots.exists(wh.spark, wh.path(name)) for name in MARTS)
    if not built:
        days = store(marts.with_first_day(marts.customer_days(wh.table("stg_purchases"))), "customer_days")
        daily = tables.rebuild(marts.daily_metrics(days, wh.table("stg_sessions")), wh.path("mart_daily_metrics"))
        tables.rebuild(marts.weekly_metrics(daily, days), wh.path("mart_weekly_metrics"))
    elif noted:
        _follow_days(wh, noted)
    if noted or not built:
        totals = store(marts.product_totals_of(wh.table("product_days"), wh.table("product_orders")), "product_totals")
        tables.rebuild(marts.product_metrics(totals), wh.path("mart_product_metrics"))
    snapshots.clear(wh.spark, wh.path("mart_days"))


def _follow_days(wh: Warehouse, dates: list) -> None:
    """Compute the days given anew, and the weeks they lie in; other rows stay as they are."""
    bought, sessions, users = wh.table("stg_purchases"), wh.table("stg_sessions"), wh.table("stg_users")
    known = marts.with_known_first_day(marts.customer_days(bought.where(F.col("purchase_date").isin(dates))), users)
    daily = marts.daily_metrics(known, sessions.where(F.col("session_date").isin(dates)))
    old = wh.table("mart_daily_metrics").where(tables.in_days("date", dates) == F.lit(False))
    daily = tables.rebuild(old.unionByName(daily), wh.path("mart_daily_metrics"))
    starts = sorted({day - timedelta(days=day.weekday()) for day in dates})
    in_weeks = [start + timedelta(days=n) for start in starts for n in range(7)]
    customers = marts.customer_days(bought.where(F.col("purchase_date").isin(in_weeks)))
    weekly = marts.weekly_metrics(daily.where(F.col("date").isin(in_weeks)), customers)
    old = wh.table("mart_weekly_metrics").where(tables.in_days("week_start", starts) == F.lit(False))
    tables.rebuild(old.unionByName(weekly), wh.path("mart_weekly_metrics"))


def all_checks(table) -> DataFrame:
    """Every check; ``table`` gives a stored or built table by name.

    Each table is read once for all that concerns it alone, and its keys once
    more where it is compared with another.
    """
    daily, weekly = table("mart_daily_metrics"), table("mart_weekly_metrics")
    own = {"mart_daily_metrics": quality.daily_assertions()}
    return quality.combine(
        [
            *[
                quality.table_checks(name, table(name), UNIQUE_KEYS.get(name), cols, own.get(name))
                for name, cols in REQUIRED.items()
            ],
            quality.relationships(
                "relationships stg_purchase_items.event_id",
                table("stg_purchase_items"),
                "event_id",
                table("stg_purchases"),
                "event_id",
            ),
            quality.weekly_reconciles(weekly, daily),
        ]
    )


# The columns each check looks at.
UNIQUE_KEYS = {
    "stg_sessions": "session_key",
    "stg_purchases": "event_id",
    "stg_purchase_items": "item_event_id",
    "stg_users": "user_pseudo_id",
    "mart_daily_metrics": "date",
    "mart_weekly_metrics": "week_start",
}
REQUIRED = {
    "stg_sessions": ["session_key", "user_pseudo_id", "ga_session_id"],
    "stg_purchases": ["event_id", "transaction_id"],
    "stg_purchase_items": ["item_event_id", "event_id"],
    "stg_users": ["user_pseudo_id"],
    "mart_daily_metrics": ["date"],
    "mart_weekly_metrics": ["week_start"],
    "mart_product_metrics": ["item_name"],
}


def publish(wh: Warehouse) -> None:
    for name, (mart, build) in REPORT_BUILDERS.items():
        tables.write_report(build(wh.table(mart)), wh.path(f"reports/{name}"))


def run(
    spark: SparkSession,
    shards: DataFrame,
    root: str,
    override: str | None = None,
    full_refresh: bool = False,
    lookback_days: int | None = None,
) -> dict:
    """One run from source shards to reports; raises when a check fails.

    Days that an earlier run has loaded and not staged are staged by this one.
    ``lookback_days`` recounts only the last days; missing days are always found.
    """
    wh = Warehouse(spark, root)
    wh.ensure_raw()
    whole = full_refresh or not wh.staged()
    days = discovery.day_list(
        discovery.dates_to_process(shards, wh.events(), wh.ledger(), override, lookback_days)
    )
    failed: list[str] = []
    if whole:
        if days:
            backfill(wh, shards, days)
        elif wh.ledger().isEmpty():
            return {"days": []}
        for name in MARTS:  # built whole again
            snapshots.forget(spark, wh.path(name))
        stage(wh, None)
    else:
        if days:
            failed = load_each(wh, shards, days)
        # Staging follows the raw tables as they are now, failed days included.
        behind = discovery.day_list(discovery.days_to_stage(wh.ledger()))
        if behind:
            stage(wh, behind)
        if failed:
            raise RuntimeError(f"days not loaded: {', '.join(failed)}")
    build_marts(wh)
    loaded = F.col(SUFFIX).isin(days)
    quality.gate(
        quality.combine(
            [
                all_checks(wh.table),
                quality.collapsed_purchases(staging.purchase_events(wh.events().where(loaded))).where(
                    F.col("check_name").startswith("differing")
                ),
                quality.days_differing(
                    quality.source_vs_raw(shards.where(loaded), wh.events().where(loaded))
                ),
            ]
        )
    )
    publish(wh)
    wh.tidy()
    return {"days": days}
