"""Incremental maintenance of stored staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import session_key
from ..sources.shards import SUFFIX
from .staging import session_starts, sessions


def after_watermark(
    rows: DataFrame, target: DataFrame, date_column: str, target_date_column: str
) -> DataFrame:
    """Rows of days after the last day of ``target``; all rows when it is empty.

    The last day is read first and becomes a literal, so that a table
    partitioned by day is pruned when planned.
    """
    last = target.agg(F.max(target_date_column)).first()[0]
    return rows if last is None else rows.where(F.col(date_column) > F.lit(last))


def sync_schema(target: DataFrame, wanted: StructType) -> DataFrame:
    """``target`` with exactly the columns of ``wanted``: new ones NULL, old ones dropped."""
    present = set(target.columns)
    return target.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in wanted.fields
        ]
    )


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``batch`` added, replacing those of equal key.

    ``batch`` has one row per key, which the staging builders guarantee. The
    result is a new table: write it beside the old one, then point readers at it.
    """
    kept = sync_schema(target, batch.schema).join(batch.select(key), key, "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


def replace_days(
    target: DataFrame, rebuilt: DataFrame, date_column: str, days: list
) -> DataFrame:
    """``target`` with the given days taken from ``rebuilt``.

    For tables whose key includes the day (purchases, items): no join is needed.
    """
    in_days = F.coalesce(F.col(date_column).isin(days), F.lit(False))
    kept = sync_schema(target, rebuilt.schema).where(~in_days)
    return kept.unionByName(rebuilt.where(in_days))


def _keyed_starts(raw: DataFrame) -> DataFrame:
    return session_starts(raw).withColumn("session_key", session_key())


def touched_sessions(raw: DataFrame, suffixes: list[str]) -> DataFrame:
    """Keys of the sessions that have an event on one of the days."""
    on_days = raw.where(F.col(SUFFIX).isin(suffixes))
    return _keyed_starts(on_days).select("session_key").distinct()


def purchase_dates(raw: DataFrame, suffixes: list[str]) -> DataFrame:
    """Dates of the events that the shards of some days hold; events without one have no partition to rebuild."""
    on_days = raw.where(F.col(SUFFIX).isin(suffixes) & F.col("event_date_dt").isNotNull())
    return on_days.select("event_date_dt").distinct()


def session_days(raw: DataFrame) -> DataFrame:
    """Which sessions have an event in the shard of which day; kept as an index, by day."""
    return _keyed_starts(raw).select("session_key", SUFFIX).distinct()


def event_days(events: DataFrame, items: DataFrame) -> DataFrame:
    """Which event dates lie in the shard of which day; one without a date has no partition to rebuild."""
    pairs = [rows.where("event_date_dt IS NOT NULL").select("event_date_dt", SUFFIX).distinct() for rows in (events, items)]
    return pairs[0].union(pairs[1]).distinct()


def rebuild_sessions(raw: DataFrame, touched: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The touched sessions, from all their events on all days.

    The days that hold such events are found first, from one row per day and
    session (``index``, or else counted from ``raw``), and reach the driver as a
    list of days. Only those days are then read in full. Sessions are built
    before the join with the touched keys, so a session of very many events is
    one row by then.
    """
    seen = session_days(raw) if index is None else index
    days = seen.join(touched, "session_key", "left_semi").select(SUFFIX).distinct().collect()
    on_days = raw.where(F.col(SUFFIX).isin([row[0] for row in days]))
    return sessions(on_days).join(touched, "session_key", "left_semi")


def merge_sessions(target: DataFrame, rebuilt: DataFrame, touched: DataFrame) -> DataFrame:
    """``target`` without the touched sessions, plus the rebuilt ones.

    A session that begins before a reloaded day keeps its earlier date, and one
    whose events have gone disappears, so the result equals a full build when
    ``touched`` holds the sessions of the days before and after the reload.
    """
    kept = sync_schema(target, rebuilt.schema).join(touched, "session_key", "left_anti")
    return kept.select(*rebuilt.columns).unionByName(rebuilt)


def refresh_sessions(target: DataFrame, raw: DataFrame, touched: DataFrame) -> DataFrame:
    """A whole session table brought up to date. ``touched`` should be stored."""
    return merge_sessions(target, rebuild_sessions(raw, touched), touched)
