"""Marts as report tables with display names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import round_half_up

# Display name of each report column and the mart column shown.
MONEY_AND_COUNTS = {
    "Gross Revenue (USD)": "gross_revenue",
    "Refund Amount (USD)": "refund_amount",
    "Net Revenue (USD)": "net_revenue",
    "Total Orders": "total_orders",
    "Avg Order Value (USD)": "avg_order_value",
    "Unique Customers": "unique_customers",
    "New Customers": "new_customers",
    "Returning Customers": "returning_customers",
    "Sessions": "sessions",
}
BY_REVENUE = {
    "Revenue Rank": "revenue_rank",
    "Product": "item_name",
    "Category": "category",
    "Total Revenue (USD)": "total_revenue",
    "Total Refunds (USD)": "total_refunds",
    "Net Revenue (USD)": "net_revenue",
    "Quantity Sold": "total_quantity_sold",
    "Orders": "total_orders",
    "Avg Price (USD)": "avg_price_usd",
    "Quantity Rank": "quantity_rank",
}
BY_QUANTITY = {
    "Quantity Rank": "quantity_rank",
    "Product": "item_name",
    "Category": "category",
    "Quantity Sold": "total_quantity_sold",
    "Orders": "total_orders",
    "Total Revenue (USD)": "total_revenue",
    "Total Refunds (USD)": "total_refunds",
    "Net Revenue (USD)": "net_revenue",
    "Avg Price (USD)": "avg_price_usd",
    "Revenue Rank": "revenue_rank",
}
TOP = 20


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _percent(rate: str) -> Column:
    return F.coalesce(round_half_up(F.col(rate) * 100, 2), F.lit(0.0))


def daily_report(daily: DataFrame) -> DataFrame:
    return daily.orderBy("date").select(
        F.col("date").cast("string").alias("Date"),
        *[_or_zero(name).alias(title) for title, name in MONEY_AND_COUNTS.items()],
        _percent("conversion_rate").alias("Conversion Rate (%)"),
    )


def weekly_report(weekly: DataFrame) -> DataFrame:
    return weekly.orderBy("week_start").select(
        F.col("week_start").cast("string").alias("Week Start (Monday)"),
        F.col("week_end").cast("string").alias("Week End (Sunday)"),
        *[_or_zero(name).alias(title) for title, name in MONEY_AND_COUNTS.items()],
        _percent("conversion_rate").alias("Conversion Rate (%)"),
    )


def _top_products(products: DataFrame, rank: str, columns: dict[str, str]) -> DataFrame:
    texts = {"item_name", "category"}
    return (
        products.orderBy(rank, "item_name", "item_id")
        .limit(TOP)
        .select(
            *[
                F.coalesce(F.col(name), F.lit("" if name in texts else 0)).alias(title)
                for title, name in columns.items()
            ]
        )
    )


def top_products_by_revenue(products: DataFrame) -> DataFrame:
    """The 20 products of highest revenue rank; ties by name, then id."""
    return _top_products(products, "revenue_rank", BY_REVENUE)


def top_products_by_quantity(products: DataFrame) -> DataFrame:
    """The 20 products of highest quantity rank; ties by name, then id."""
    return _top_products(products, "quantity_rank", BY_QUANTITY)
