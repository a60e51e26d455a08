"""Which days to load, and the record of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_suffix, parse_suffix
from ..schemas import PIPELINE_RUNS
from ..sources.shards import in_range, shard_dates, shard_row_counts


def completed_dates(ledger: DataFrame) -> DataFrame:
    """Days with at least one successful load; a later failure does not undo it."""
    return (
        ledger.where((F.col("layer") == "raw") & (F.col("status") == "success"))
        .select(day_suffix("run_date").alias("date_suffix"))
        .distinct()
    )


def missing_dates(shards: DataFrame, ledger: DataFrame) -> DataFrame:
    """Source days that were never loaded successfully."""
    return shard_dates(shards).join(completed_dates(ledger), "date_suffix", "left_anti")


def incomplete_dates(
    shards: DataFrame,
    raw: DataFrame,
    lookback_days: int | None = None,
    today: Column | None = None,
) -> DataFrame:
    """Days whose source holds more rows than the raw table, or that raw lacks.

    Both sides are counted by day suffix, the key that a reload replaces. With
    ``lookback_days`` only the last days up to ``today`` are compared.
    """
    if lookback_days is not None:
        last = F.current_date() if today is None else today
        first, last = day_suffix(F.date_sub(last, lookback_days)), day_suffix(last)
        shards, raw = in_range(shards, first, last), in_range(raw, first, last)
    compared = shard_row_counts(shards, "source_rows").join(
        shard_row_counts(raw, "raw_rows"), "date_suffix", "left"
    )
    behind = F.col("raw_rows").isNull() | (F.col("source_rows") > F.col("raw_rows"))
    return compared.where(behind).select("date_suffix")


def dates_to_process(
    shards: DataFrame,
    raw: DataFrame,
    ledger: DataFrame,
    override: str | None = None,
    lookback_days: int | None = None,
    today: Column | None = None,
) -> DataFrame:
    """Missing and incomplete days; an override names the only day.

    ``lookback_days`` limits the recount of loaded days, not the missing ones.
    """
    if override is not None:
        return shards.sparkSession.createDataFrame([(override,)], "date_suffix string")
    behind = incomplete_dates(shards, raw, lookback_days, today)
    return missing_dates(shards, ledger).union(behind).distinct()


def days_to_stage(ledger: DataFrame) -> DataFrame:
    """Days whose raw tables a load has touched since they were last staged.

    A failed load counts too, since it may have replaced one of the tables. A
    stage covers the loads that ended before it began.
    """
    loaded = F.max(F.when(F.col("layer") == "raw", F.col("completed_at")))
    staged = F.max(
        F.when((F.col("layer") == "staging") & (F.col("status") == "success"), F.col("started_at"))
    )
    latest = ledger.groupBy("run_date").agg(loaded.alias("loaded"), staged.alias("staged"))
    behind = F.col("loaded").isNotNull() & (
        F.col("staged").isNull() | (F.col("loaded") > F.col("staged"))
    )
    return latest.where(behind).select(day_suffix("run_date").alias("date_suffix"))


def day_list(dates: DataFrame) -> list[str]:
    """The days, oldest first. One short text per calendar day reaches the driver."""
    return sorted(row["date_suffix"] for row in dates.collect())


def ledger_runs(
    rows_per_day: DataFrame,
    status: Column,
    error: Column,
    started: Column,
    completed: Column,
    layer: str = "raw",
) -> DataFrame:
    """Ledger rows for many days, from ``date_suffix`` and ``rows_processed``."""
    return rows_per_day.select(
        F.uuid().alias("run_id"),
        parse_suffix("date_suffix").alias("run_date"),
        F.lit(layer).alias("layer"),
        status.alias("status"),
        F.when(status == "success", F.col("rows_processed"))
        .otherwise(0)
        .cast("bigint")
        .alias("rows_processed"),
        error.alias("error_message"),
        started.alias("started_at"),
        completed.alias("completed_at"),
        ((F.unix_micros(completed) - F.unix_micros(started)) / F.lit(1e6)).alias(
            "duration_seconds"
        ),
    ).select(*[F.col(name).cast(kind.removesuffix(" not null")).alias(name) for name, kind in PIPELINE_RUNS.items()])


def recent_runs(ledger: DataFrame, as_of: Column | None = None, days: int = 7) -> DataFrame:
    """Loads begun in the last ``days`` days, newest first."""
    now = F.current_timestamp() if as_of is None else as_of
    since = now - F.make_dt_interval(days=F.lit(days))
    return (
        ledger.where(F.col("started_at") >= since)
        .select(
            "run_date", "status", "rows_processed", "duration_seconds", "error_message", "started_at"
        )
        .orderBy(F.col("started_at").desc())
        .drop("started_at")
    )


def row_count_anomaly(
    ledger: DataFrame, window_days: int = 7, tolerance: float = 0.2
) -> DataFrame:
    """Days whose row count is more than ``tolerance`` off the mean of the days before.

    The last successful load of a day gives its count. Each day adds its count
    to the days after it, which replaces a window over the whole ledger.
    """
    per_day = (
        ledger.where((F.col("layer") == "raw") & (F.col("status") == "success"))
        .groupBy("run_date")
        .agg(F.max_by("rows_processed", "started_at").alias("row_count"))
    )
    later = F.transform(
        F.sequence(F.lit(1), F.lit(window_days)), lambda n: F.date_add("run_date", n)
    )
    before = (
        per_day.select(F.explode(later).alias("run_date"), "row_count")
        .groupBy("run_date")
        .agg((F.sum("row_count") / F.count("row_count")).alias("average"))
    )
    return (
        per_day.join(before, "run_date")
        .where(F.abs(F.col("row_count") - F.col("average")) > tolerance * F.col("average"))
        .select("run_date", "row_count", "average")
    )
