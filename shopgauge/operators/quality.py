"""Data checks. Each gives rows of ``check_name`` and ``failing_rows``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import amount, cents
from ..sources.shards import SUFFIX
from .marts import weekly_rollup

# Fixed value: accepted difference in money.
TOLERANCE = 0.01


class CheckFailed(Exception):
    """Some check has failing rows, so nothing may be published."""


def _summary(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count("*").alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def combine(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique(table: str, df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; a missing key is not a value."""
    repeated = (
        df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)
    )
    return _summary(f"unique {table}.{key}", repeated)


def not_null(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which a column is missing; all columns of a table in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[
            F.struct(F.lit(f"not_null {table}.{c}").alias("check_name"), F.col(c).alias("n"))
            for c in columns
        ]
    )
    return counted.select(F.explode(pairs).alias("p")).select(
        "p.check_name", F.col("p.n").alias("failing_rows")
    )


def table_checks(
    table: str,
    df: DataFrame,
    key: str | None = None,
    required: tuple | list = (),
    assertions: dict[str, Column] | None = None,
) -> DataFrame:
    """All checks that look at one table only, in one pass over it.

    Rows are counted by key, which merges before the shuffle; the missing
    values and failing rows are counted along. Gives what ``unique``,
    ``not_null`` and ``assertion`` give one by one.
    """
    wanted = {f"not_null {table}.{c}": F.col(c).isNull() for c in required} | (assertions or {})
    counted = [F.count_if(failing).alias(f"_{i}") for i, failing in enumerate(wanted.values())]
    totals = [F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(wanted))]
    names = list(wanted)
    if key is None:
        one = df.agg(*counted)
    else:
        repeated = F.col("_key").isNotNull() & (F.col("_n") > 1)
        by_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *counted)
        one = by_key.agg(*totals, F.count_if(repeated).alias(f"_{len(names)}"))
        names.append(f"unique {table}.{key}")
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").alias("n"))
            for i, name in enumerate(names)
        ]
    )
    return one.select(F.explode(rows).alias("r")).select(
        "r.check_name", F.col("r.n").alias("failing_rows")
    )


def relationships(
    name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key has no parent; a missing key is not looked up.

    Children are counted per key before the join, so a frequent key is one row.
    """
    keys = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("k"))
        .agg(F.count("*").alias("n"))
    )
    orphans = keys.join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def assertion(name: str, df: DataFrame, failing: Column) -> DataFrame:
    return _summary(name, df.where(failing))


def daily_assertions(tolerance: float = TOLERANCE) -> dict[str, Column]:
    """What fails in a row of the daily mart, by the name of the check."""
    expected = F.col("gross_revenue") - F.col("refund_amount")
    return {
        "net_revenue_identity": _differs(F.col("net_revenue"), expected, tolerance),
        "new_le_orders": F.col("new_customers") > F.col("total_orders"),
        "rate_non_negative": F.col("conversion_rate") < 0,
    }


def _daily_assertion(name: str, daily: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return assertion(name, daily, daily_assertions(tolerance)[name])


def net_revenue_identity(daily: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    return _daily_assertion("net_revenue_identity", daily, tolerance)


def new_customers_within_orders(daily: DataFrame) -> DataFrame:
    return _daily_assertion("new_le_orders", daily)


def rate_non_negative(daily: DataFrame) -> DataFrame:
    return _daily_assertion("rate_non_negative", daily)


def weekly_reconciles(
    weekly: DataFrame,
    daily: DataFrame,
    tolerance: float = TOLERANCE,
    first_day: str = "monday",
) -> DataFrame:
    """Weeks whose revenue, orders or sessions are not the sum of their days."""
    sums = weekly_rollup(daily, first_day)
    w, d = weekly.alias("w"), sums.alias("d")
    failing = (
        _differs(F.col("w.gross_revenue"), F.col("d.gross_revenue"), tolerance)
        | (F.col("w.total_orders") != F.col("d.total_orders"))
        | (F.col("w.sessions") != F.col("d.sessions"))
    )
    joined = w.join(d, F.col("w.week_start") == F.col("d.week_start"))
    return assertion("weekly_reconciles", joined, failing)


def _differs(a: Column, b: Column, tolerance: float) -> Column:
    """Amounts in cents apart by more than the tolerance, free of double noise."""
    gap = a.cast("decimal(28,6)") - b.cast("decimal(28,6)")
    return F.abs(gap) > F.lit(tolerance).cast("decimal(18,6)")


def source_vs_raw(shards: DataFrame, raw: DataFrame) -> DataFrame:
    """Days on which row count or purchase revenue differ between source and raw."""

    def per_day(rows: DataFrame, side: str) -> DataFrame:
        revenue = F.when(
            F.col("event_name") == "purchase",
            amount("ecommerce.purchase_revenue_in_usd"),
        )
        return rows.groupBy(F.col(SUFFIX).alias("date_suffix")).agg(
            F.count("*").alias(f"{side}_rows"), cents(F.sum(revenue)).alias(f"{side}_revenue")
        )

    both = per_day(shards, "source").join(per_day(raw, "raw"), "date_suffix", "full")
    same = F.col("source_rows").eqNullSafe(F.col("raw_rows")) & F.col(
        "source_revenue"
    ).eqNullSafe(F.col("raw_revenue"))
    return both.where(~same)


def collapsed_purchases(events: DataFrame) -> DataFrame:
    """Purchase events delivered more than once, and those whose copies differ.

    ``events`` as ``staging.purchase_events`` gives them. Copies merge before
    the shuffle, so any number of them costs one row per task.
    """
    body = [name for name in events.columns if name != "event_id"]
    copies = events.groupBy("event_id").agg(
        F.count("*").alias("n"), F.min(F.struct(*body)).alias("low"), F.max(F.struct(*body)).alias("high")
    )
    counted = copies.agg(
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(~F.col("low").eqNullSafe(F.col("high"))).alias("differing"),
    )
    rows = F.array(
        *[
            F.struct(F.lit(f"{kind} stg_purchases.event_id").alias("check_name"), F.col(kind).alias("n"))
            for kind in ("repeated", "differing")
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select(
        "r.check_name", F.col("r.n").alias("failing_rows")
    )


def days_differing(differences: DataFrame) -> DataFrame:
    """The days of ``source_vs_raw`` as one check row."""
    return _summary("source_vs_raw", differences)


def gate(checks: DataFrame) -> None:
    """Raise when any check has failing rows. One row per check reaches the driver."""
    failed = checks.where(F.col("failing_rows") > 0).orderBy("check_name").collect()
    if failed:
        raise CheckFailed(", ".join(f"{r['check_name']}: {r['failing_rows']}" for r in failed))
