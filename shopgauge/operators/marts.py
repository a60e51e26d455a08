"""Daily, weekly and product metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import week_end, week_start
from ..functions.money import amount, cents, ratio, total, zero_if_null
from .ranking import RANGES, global_ranks, top_with_ranks


def customer_days(purchases: DataFrame) -> DataFrame:
    """Orders and money per day and customer.

    All customer metrics start here: a customer has at most one row per day,
    so later steps need no distinct count and a very active customer is no
    longer a heavy key. An order is a purchase event.
    """
    return purchases.groupBy(F.col("purchase_date").alias("date"), "user_pseudo_id").agg(
        F.sum(amount("revenue_usd")).alias("revenue"),
        F.sum(zero_if_null(amount("refund_usd"))).alias("refund"),
        F.count("*").alias("orders"),
    )


def with_first_day(days: DataFrame) -> DataFrame:
    """Adds the customer's first purchase date, found among the same rows."""
    per_customer = Window.partitionBy("user_pseudo_id")
    return days.withColumn("first_purchase_date", F.min("date").over(per_customer))


def new_vs_returning(purchases: DataFrame, users: DataFrame) -> DataFrame:
    """New and returning customers per day, by the first purchase date of the user table."""
    first = users.select("user_pseudo_id", "first_purchase_date")
    flagged = customer_days(purchases).join(first, "user_pseudo_id", "left")
    return _customer_counts(flagged).select(
        "date",
        "unique_customers",
        "new_customers",
        (F.col("unique_customers") - F.col("new_customers")).alias("returning_customers"),
    )


def _customer_aggregates() -> list:
    is_new = F.col("date") == F.col("first_purchase_date")
    return [
        F.count("user_pseudo_id").alias("unique_customers"),
        F.count(F.when(is_new, F.col("user_pseudo_id"))).alias("new_customers"),
    ]


def _customer_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("date").agg(*_customer_aggregates())


def with_known_first_day(days: DataFrame, users: DataFrame) -> DataFrame:
    """As ``with_first_day``, for some days only: the first purchase date is that of the user table."""
    return days.join(users.select("user_pseudo_id", "first_purchase_date"), "user_pseudo_id", "left")


def daily_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(F.col("session_date").alias("date")).agg(
        F.countDistinct("session_key").alias("sessions")
    )


def daily_metrics(days: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per day on which anything was bought or any session began.

    ``days`` comes from ``with_first_day(customer_days(...))``.
    """
    gross, refund, orders = F.sum("revenue"), F.sum("refund"), F.sum("orders")
    bought = days.groupBy("date").agg(
        cents(gross).alias("gross_revenue"),
        cents(refund).alias("refund_amount"),
        cents(gross - refund).alias("net_revenue"),
        orders.alias("total_orders"),
        ratio(gross, orders, 2).alias("avg_order_value"),
        *_customer_aggregates(),
    )
    money = ["gross_revenue", "refund_amount", "net_revenue"]
    both = bought.join(daily_sessions(sessions), "date", "full").na.fill(
        0, [*money, "total_orders", "avg_order_value"]
        + ["unique_customers", "new_customers", "sessions"]
    )
    return both.select(
        "date",
        *money,
        "total_orders",
        "avg_order_value",
        "unique_customers",
        "new_customers",
        (F.col("unique_customers") - F.col("new_customers")).alias("returning_customers"),
        "sessions",
        ratio("total_orders", "sessions", 4).alias("conversion_rate"),
    )


def weekly_unique_customers(days: DataFrame, first_day: str = "monday") -> DataFrame:
    """Customers per week; one who buys on several days counts once."""
    return (
        days.select(week_start("date", first_day).alias("week_start"), "user_pseudo_id")
        .distinct()
        .groupBy("week_start")
        .agg(F.count("user_pseudo_id").alias("unique_customers"))
    )


def weekly_rollup(daily: DataFrame, first_day: str = "monday") -> DataFrame:
    """Sums of the daily rows that add up over a week."""
    return daily.groupBy(week_start("date", first_day).alias("week_start")).agg(
        cents(F.sum(total("gross_revenue"))).alias("gross_revenue"),
        cents(F.sum(total("refund_amount"))).alias("refund_amount"),
        cents(F.sum(total("net_revenue"))).alias("net_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("sessions").alias("sessions"),
        F.sum("new_customers").alias("new_customers"),
    )


def weekly_metrics(daily: DataFrame, days: DataFrame, first_day: str = "monday") -> DataFrame:
    """One row per week: daily sums, with the customers counted anew."""
    unique = F.coalesce("unique_customers", F.lit(0))
    return (
        weekly_rollup(daily, first_day)
        .join(weekly_unique_customers(days, first_day), "week_start", "left")
        .select(
            "week_start",
            week_end("week_start").alias("week_end"),
            "gross_revenue",
            "refund_amount",
            "net_revenue",
            "total_orders",
            ratio("gross_revenue", "total_orders", 2).alias("avg_order_value"),
            unique.alias("unique_customers"),
            "new_customers",
            (unique - F.col("new_customers")).alias("returning_customers"),
            "sessions",
            ratio("total_orders", "sessions", 4).alias("conversion_rate"),
        )
    )


def product_days(items: DataFrame) -> DataFrame:
    """Unrounded sums per product name, id and day, to be stored by day and added up by ``product_totals_of``."""
    return _named(items).groupBy("item_name", "item_id", "purchase_date").agg(*_product_sums())


def product_orders(items: DataFrame) -> DataFrame:
    """The transactions of each product and day, once each. Only the count of orders needs them."""
    return _named(items).select("item_name", "item_id", "transaction_id", "purchase_date").distinct()


def _named(items: DataFrame) -> DataFrame:
    return items.where(F.col("item_name").isNotNull())


def _product_sums() -> list:
    return [
        F.max("category_l1").alias("category"),
        F.max("category_l2").alias("sub_category"),
        F.sum(amount("item_revenue_usd")).alias("revenue"),
        F.sum(amount("item_refund_usd")).alias("refunds"),
        F.sum("quantity").alias("quantity"),
        F.sum(amount("price_in_usd")).alias("price"),
        F.count("price_in_usd").alias("prices"),
    ]


_ADDED = ("revenue", "refunds", "quantity", "orders", "price", "prices")


def product_totals_of(days: DataFrame, orders: DataFrame) -> DataFrame:
    """Unrounded totals per product from what was stored by day; a transaction on several days is one order."""
    counted = (
        orders.select("item_name", "item_id", "transaction_id")
        .distinct()
        .groupBy("item_name", "item_id")
        .agg(F.count("transaction_id").alias("orders"))
    )
    return (
        days.drop("purchase_date")
        .unionByName(counted, allowMissingColumns=True)
        .groupBy("item_name", "item_id")
        .agg(
            F.max("category").alias("category"),
            F.max("sub_category").alias("sub_category"),
            *[F.sum(name).alias(name) for name in _ADDED],
        )
    )


def product_totals(items: DataFrame) -> DataFrame:
    """Unrounded totals per product name and id, from one pass over the items.

    Orders are distinct transaction ids. Spark adds up per product and
    transaction before the shuffle and per product after it, so a product of
    very many transactions is spread over the tasks.
    """
    return _named(items).groupBy("item_name", "item_id").agg(
        *_product_sums(), F.countDistinct("transaction_id").alias("orders")
    )


#: What products are ranked by.
PRODUCT_RANKS = {"revenue_rank": "revenue", "quantity_rank": "quantity"}


def product_metrics(totals: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Stored product totals with their ranks by revenue and by quantity.

    Ranking counts the totals first, by two jobs that start here.
    """
    return _product_columns(global_ranks(totals, PRODUCT_RANKS, ranges))


def top_product_metrics(totals: DataFrame, by: str, n: int) -> DataFrame:
    """The rows of ``product_metrics`` that are first by one of its ranks; ties by name, then id."""
    return _product_columns(top_with_ranks(totals, PRODUCT_RANKS, by, n, ["item_name", "item_id"]))


def _product_columns(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "item_name",
        "item_id",
        "category",
        "sub_category",
        cents(F.col("revenue")).alias("total_revenue"),
        cents(F.col("refunds")).alias("total_refunds"),
        cents(F.col("revenue") - F.col("refunds")).alias("net_revenue"),
        F.col("quantity").alias("total_quantity_sold"),
        F.col("orders").alias("total_orders"),
        ratio("price", "prices", 2).alias("avg_price_usd"),
        "revenue_rank",
        "quantity_rank",
    )
