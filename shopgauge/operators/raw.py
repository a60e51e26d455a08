"""Source shards to raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_suffix
from ..functions.keys import event_key, item_key
from ..schemas import EVENT, ITEM, RAW_EVENTS, RAW_PURCHASE_ITEMS


def raw_events(shards: DataFrame) -> DataFrame:
    """Source events with their date, their key and the load time.

    Every nested column is passed through as it is. The items stay behind:
    they have a grain of their own.
    """
    return shards.select(
        parse_suffix("event_date").alias("event_date_dt"),
        event_key().alias("event_id"),
        *EVENT,
        F.current_timestamp().alias("ingested_at"),
        "source_table_suffix",
    ).select(*RAW_EVENTS)


def raw_purchase_items(shards: DataFrame) -> DataFrame:
    """One row per item of a purchase, with its position counted from zero.

    Purchases are filtered and reduced to the needed leaves before the array
    is opened. A purchase with no items, or no item array, gives no row.
    """
    opened = (
        shards.where(F.col("event_name") == "purchase")
        .select(
            "event_date",
            event_key().alias("event_id"),
            F.col("ecommerce.transaction_id").alias("transaction_id"),
            "user_pseudo_id",
            "event_timestamp",
            "source_table_suffix",
            "items",
        )
        # Opening an expression, not the bare column, keeps Spark from adding a
        # filter on the array's size that would compute a derived array twice.
        .select("*", F.posexplode(F.coalesce("items", F.array())).alias("position", "item"))
    )
    return opened.select(
        parse_suffix("event_date").alias("event_date_dt"),
        item_key("position").alias("item_event_id"),
        "event_id",
        "transaction_id",
        "user_pseudo_id",
        F.col("position").cast("bigint").alias("item_position"),
        *[F.col(f"item.{name}").alias(name) for name in ITEM],
        F.current_timestamp().alias("ingested_at"),
        "source_table_suffix",
    ).select(*RAW_PURCHASE_ITEMS)
