"""Raw tables to sessions, purchases, purchase items and users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import from_micros
from ..functions.keys import session_key
from ..functions.money import amount, cents, zero_if_null
from ..functions.params import has_any_param, has_params, has_value, param

# Parameter names and the type each is stored under.
SESSION_PARAMS = {
    "ga_session_id": "int",
    "ga_session_number": "int",
    "session_engaged": "string",
    "engaged_session_event": "int",
    "page_location": "string",
    "page_title": "string",
    "page_referrer": "string",
}
USER_PARAMS = {"ga_session_id": "int", "ga_session_number": "int"}
PURCHASE_PARAMS = {
    "ga_session_id": "int",
    "ga_session_number": "int",
    "currency": "string",
    "value": "float",
    "tax": "float",
    "payment_type": "string",
    "coupon": "string",
    "shipping_tier": "string",
}

# Output name of each landing attribute and the parameter it comes from.
LANDING = {
    "landing_page": "page_location",
    "landing_page_title": "page_title",
    "referrer": "page_referrer",
}

SESSION_ATTRIBUTES = {
    "traffic_source": "traffic_source.source",
    "traffic_medium": "traffic_source.medium",
    "traffic_campaign": "traffic_source.name",
    "device_category": "device.category",
    "operating_system": "device.operating_system",
    "browser": "device.web_info.browser",
    "language": "device.language",
    "country": "geo.country",
    "region": "geo.region",
    "city": "geo.city",
}

FIRST_TOUCH = {
    "acquisition_source": "traffic_source.source",
    "acquisition_medium": "traffic_source.medium",
    "acquisition_campaign": "traffic_source.name",
    "first_device_category": "device.category",
    "country": "geo.country",
    "city": "geo.city",
}


def _leaves(paths: dict[str, str]) -> Column:
    return F.struct(*[F.col(path).alias(name) for name, path in paths.items()])


def _earliest(value: Column | str) -> Column:
    """The value that came first, as a struct whose last field is the value.

    Equal times are settled by event id and then by the value, so the result
    does not depend on row order, and partial results merge on the map side.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.min(F.struct("event_timestamp", "event_id", value.alias("value")))


def _earliest_non_null(name: str) -> Column:
    entry = F.struct("event_timestamp", "event_id", F.col(name).alias("value"))
    return F.min(F.when(F.col(name).isNotNull(), entry))


def pivot_params(events: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Each wanted parameter as a column of its own."""
    return events.select("*", *[param(key, kind).alias(key) for key, kind in wanted.items()])


# --- sessions ---------------------------------------------------------------


def session_starts(raw: DataFrame) -> DataFrame:
    """Session start events that carry a session id, with their parameters pivoted."""
    events = raw.where(F.col("event_name") == "session_start").where(
        has_value("ga_session_id", SESSION_PARAMS["ga_session_id"])
    )
    return pivot_params(events, SESSION_PARAMS).select(
        "event_id",
        "event_date_dt",
        "event_timestamp",
        "user_pseudo_id",
        "user_id",
        "user_first_touch_timestamp",
        *SESSION_PARAMS,
        _leaves(SESSION_ATTRIBUTES).alias("attributes"),
        "source_table_suffix",
    )


def landing_attributes(raw: DataFrame) -> DataFrame:
    """First known page, title and referrer of each session."""
    return (
        session_starts(raw)
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(*[_earliest_non_null(source).alias(name) for name, source in LANDING.items()])
        .select(
            "user_pseudo_id",
            "ga_session_id",
            *[F.col(f"{name}.value").alias(name) for name in LANDING],
        )
    )


def sessions(raw: DataFrame) -> DataFrame:
    """One row per user and session id.

    A sign-in during a session does not split it: the largest user id is kept.
    Repeated deliveries of an event change none of the aggregates.
    """
    grouped = (
        session_starts(raw)
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(
            F.max("user_id").alias("user_id"),
            F.min("event_date_dt").alias("session_date"),
            F.min("event_timestamp").alias("started"),
            F.min("user_first_touch_timestamp").alias("first_touch"),
            F.max("ga_session_number").alias("ga_session_number"),
            F.max("session_engaged").alias("session_engaged"),
            F.max("engaged_session_event").alias("engaged_session_event"),
            *[_earliest_non_null(source).alias(name) for name, source in LANDING.items()],
            _earliest("attributes").alias("first"),
        )
    )
    return grouped.select(
        session_key().alias("session_key"),
        "session_date",
        from_micros("started").alias("session_started_at"),
        "user_pseudo_id",
        "user_id",
        from_micros("first_touch").alias("user_first_touch_at"),
        "ga_session_id",
        "ga_session_number",
        F.coalesce(F.col("session_engaged") == "1", F.lit(False)).alias("is_engaged"),
        F.coalesce("engaged_session_event", F.lit(0)).alias("engaged_event_count"),
        *[F.col(f"{name}.value").alias(name) for name in LANDING],
        *[F.col(f"first.value.{name}").alias(name) for name in SESSION_ATTRIBUTES],
    )


# --- purchases --------------------------------------------------------------

# Leaves a purchase keeps, read before the rows are shuffled.
_PURCHASE_BODY = {
    "transaction_id": "ecommerce.transaction_id",
    "revenue_usd": "ecommerce.purchase_revenue_in_usd",
    "tax_usd": "ecommerce.tax_value_in_usd",
    "shipping_usd": "ecommerce.shipping_value_in_usd",
    "refund_usd": "ecommerce.refund_value_in_usd",
    "total_items": "ecommerce.total_item_quantity",
    "unique_items": "ecommerce.unique_items",
    "traffic_source": "traffic_source.source",
    "traffic_medium": "traffic_source.medium",
    "device_category": "device.category",
    "country": "geo.country",
    "city": "geo.city",
}
_PURCHASE_EVENT = ["event_id", "event_date_dt", "event_timestamp", "user_pseudo_id"]
PURCHASE_COLUMNS = [
    "event_id",
    "purchase_date",
    "event_timestamp",
    "purchased_at",
    "session_key",
    "user_pseudo_id",
    "user_id",
    "ga_session_id",
    "ga_session_number",
    "transaction_id",
    "currency",
    "revenue_usd",
    "tax_usd",
    "shipping_usd",
    "refund_usd",
    "tax_local",
    "payment_type",
    "coupon",
    "shipping_tier",
    "total_items",
    "unique_items",
    "traffic_source",
    "traffic_medium",
    "device_category",
    "country",
    "city",
]


def purchase_events(raw: DataFrame) -> DataFrame:
    """Purchase events with parameters and a transaction id, repeats included."""
    events = (
        raw.where(F.col("event_name") == "purchase")
        .where(F.col("ecommerce.transaction_id").isNotNull())
        .where(has_params())
    )
    return pivot_params(events, PURCHASE_PARAMS).select(
        *_PURCHASE_EVENT,
        "user_id",
        *[F.col(path).alias(name) for name, path in _PURCHASE_BODY.items()],
        *[key for key in PURCHASE_PARAMS if key != "value"],
    )


def purchases(raw: DataFrame) -> DataFrame:
    """One row per purchase event, flattened.

    Events delivered more than once collapse; where the copies differ, the
    smallest set of values stays, whole. Copies merge before the shuffle, so
    any number of them costs one row per task.
    """
    events = purchase_events(raw)
    body = [name for name in events.columns if name not in _PURCHASE_EVENT]
    kept = (
        events.groupBy(*_PURCHASE_EVENT)
        .agg(F.min(F.struct(*body)).alias("body"))
        .select(*_PURCHASE_EVENT, "body.*")
    )
    return kept.select(
        "*",
        F.col("event_date_dt").alias("purchase_date"),
        from_micros("event_timestamp").alias("purchased_at"),
        session_key().alias("session_key"),
        F.coalesce("tax", F.lit(0.0)).alias("tax_local"),
    ).withColumn("currency", F.coalesce("currency", F.lit("USD"))).select(*PURCHASE_COLUMNS)


def purchase_items(raw_items: DataFrame) -> DataFrame:
    """Items of purchases that have a transaction id, with null-safe revenue."""
    revenue = zero_if_null(amount("item_revenue_in_usd"))
    refund = zero_if_null(amount("item_refund_in_usd"))
    gross = amount("price_in_usd") * F.col("quantity").cast("decimal(18,0)")
    return raw_items.where(F.col("transaction_id").isNotNull()).select(
        "item_event_id",
        "event_id",
        "transaction_id",
        F.col("event_date_dt").alias("purchase_date"),
        "user_pseudo_id",
        "item_position",
        "item_id",
        "item_name",
        "item_brand",
        "item_variant",
        F.col("item_category").alias("category_l1"),
        F.col("item_category2").alias("category_l2"),
        F.col("item_category3").alias("category_l3"),
        "price_in_usd",
        "quantity",
        cents(gross).alias("gross_revenue_usd"),
        F.coalesce("item_revenue_in_usd", F.lit(0.0)).alias("item_revenue_usd"),
        F.coalesce("item_refund_in_usd", F.lit(0.0)).alias("item_refund_usd"),
        (revenue - refund).cast("double").alias("net_revenue_usd"),
        "coupon",
        "promotion_id",
        "promotion_name",
        "item_list_id",
        "item_list_name",
        "item_list_index",
        "creative_name",
        "creative_slot",
        "affiliation",
    )


# --- users ------------------------------------------------------------------


def _user_visits(raw: DataFrame, *more: str) -> DataFrame:
    return (
        raw.where(F.col("event_name") == "session_start")
        .where(has_any_param(tuple(USER_PARAMS)))
        .select(
            "event_id",
            "event_date_dt",
            "event_timestamp",
            "user_pseudo_id",
            "user_first_touch_timestamp",
            param("ga_session_id", USER_PARAMS["ga_session_id"]).alias("ga_session_id"),
            _leaves(FIRST_TOUCH).alias("attributes"),
            *more,
        )
    )


def first_touch_attributes(raw: DataFrame) -> DataFrame:
    """Where each user came from at the first visit; missing values stay missing."""
    return (
        _user_visits(raw)
        .groupBy("user_pseudo_id")
        .agg(_earliest("attributes").alias("first"))
        .select("user_pseudo_id", "first.value.*")
    )


def first_purchase(purchases_df: DataFrame) -> DataFrame:
    return purchases_df.groupBy("user_pseudo_id").agg(
        F.min("purchase_date").alias("first_purchase_date")
    )


def user_universe(raw: DataFrame, purchases_df: DataFrame) -> DataFrame:
    """Every user seen in a visit or a purchase; missing ids are one user."""
    return (
        _user_visits(raw)
        .select("user_pseudo_id")
        .union(purchases_df.select("user_pseudo_id"))
        .distinct()
    )


def user_visits(raw: DataFrame, *by: str) -> DataFrame:
    """Visits reduced to one row per user and session, and ``by`` besides.

    With the day of the shard in ``by`` the rows are a state that is stored by
    day: a reload replaces its day, and ``users_of`` merges the days.
    """
    return (
        _user_visits(raw, *by)
        .groupBy("user_pseudo_id", "ga_session_id", *by)
        .agg(
            F.min("event_date_dt").alias("first_seen_date"),
            F.min("event_timestamp").alias("first_seen"),
            F.max("event_date_dt").alias("last_seen_date"),
            F.max("user_first_touch_timestamp").alias("first_touch"),
            _earliest("attributes").alias("first"),
        )
    )


def users(raw: DataFrame, purchases_df: DataFrame) -> DataFrame:
    """One row per user with first and last visit, session count and first purchase."""
    return _merged_users(user_visits(raw), purchases_df)


def users_of(visits: DataFrame, purchases_df: DataFrame) -> DataFrame:
    """``users`` from visits that were stored by day: a session seen on several days is one."""
    sessions_ = visits.groupBy("user_pseudo_id", "ga_session_id").agg(
        F.min("first_seen_date").alias("first_seen_date"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen_date").alias("last_seen_date"),
        F.max("first_touch").alias("first_touch"),
        F.min("first").alias("first"),
    )
    return _merged_users(sessions_, purchases_df)


def moved_first_purchases(before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates that were, or have become, the first purchase of a user whose first purchase moved."""
    old = before.select("user_pseudo_id", F.col("first_purchase_date").alias("was"))
    new = after.select("user_pseudo_id", F.col("first_purchase_date").alias("is_now"))
    both = old.where("user_pseudo_id IS NOT NULL").join(new.where("user_pseudo_id IS NOT NULL"), "user_pseudo_id", "full")
    moved = both.where(~F.col("was").eqNullSafe(F.col("is_now")))
    return moved.select(F.explode(F.array_compact(F.array("was", "is_now"))).alias("date")).distinct()


def _merged_users(sessions_: DataFrame, purchases_df: DataFrame) -> DataFrame:
    """Users from one row per user and session.

    A missing session id is one session. The rows and the purchases are merged
    in a single grouping by user, which yields the universe and its attributes
    together, without a join. The user without an id is kept and has no
    attributes.
    """
    visits = sessions_.withColumn("sessions", F.lit(1).cast("bigint")).drop("ga_session_id")
    bought = purchases_df.select("user_pseudo_id", "purchase_date")
    merged = (
        visits.unionByName(bought, allowMissingColumns=True)
        .groupBy("user_pseudo_id")
        .agg(
            F.min("first_seen_date").alias("first_seen_date"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen_date").alias("last_seen_date"),
            F.max("first_touch").alias("first_touch"),
            F.sum("sessions").alias("total_sessions"),
            F.min("purchase_date").alias("first_purchase_date"),
            F.min("first").alias("first"),
        )
    )
    known = {
        "first_seen_date": F.col("first_seen_date"),
        "first_seen_at": from_micros("first_seen"),
        "last_seen_date": F.col("last_seen_date"),
        "user_first_touch_at": from_micros("first_touch"),
        "total_sessions": F.col("total_sessions"),
        "first_purchase_date": F.col("first_purchase_date"),
        **{name: F.col(f"first.value.{name}") for name in FIRST_TOUCH},
    }
    return merged.select(
        "user_pseudo_id",
        *[
            F.when(F.col("user_pseudo_id").isNotNull(), value).alias(name)
            for name, value in known.items()
        ],
    )
