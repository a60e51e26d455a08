"""The given flat tables seen as daily shards of nested shop events.

Everything is built on the row: no join, no grouping and no collected list,
so one hot user, order or product cannot make a partition or an array grow.
Expressions are written as SQL text, one per source column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import (
    DEVICE,
    ECOMMERCE,
    EVENT_DIMENSIONS,
    GEO,
    ITEM,
    PARAM,
    PARAM_VALUE,
    PRIVACY_INFO,
    SOURCE_EVENTS,
    TRAFFIC_SOURCE,
    USER_LTV,
    WEB_INFO,
    struct_type,
)

# Fixed values in microseconds: 36 hours, so that a session can cross midnight,
# and one day.
SESSION_BLOCK = 129_600_000_000
DAY = 86_400_000_000

# Event types that go by another name here.
EVENT_NAMES = {"view": "session_start"}


def _record(fields: dict[str, str], **values: str) -> str:
    """A struct of all ``fields``; those without a value are NULL."""
    return "named_struct(" + ", ".join(
        f"'{name}', CAST({values.get(name, 'NULL')} AS {kind})" for name, kind in fields.items()
    ) + ")"


_NO_PARAMS = f"CAST(array() AS array<{struct_type(PARAM)}>)"


def _param(key: str, when: str | None = None, **value: str) -> str:
    """An array of one parameter, or of none where the condition does not hold."""
    one = f"array({_record(PARAM, key=repr(key), value=_record(PARAM_VALUE, **value))})"
    return f"IF({when}, {one}, {_NO_PARAMS})" if when else one


def _params(unless: str, *entries: str) -> str:
    """All entries in order, or no entry at all."""
    return f"IF({unless}, {_NO_PARAMS}, concat({', '.join(entries)}))"


def _micros(ts: str) -> str:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})"


def _as_source(rows: DataFrame, **columns: str) -> DataFrame:
    return rows.selectExpr(
        *[
            f"CAST({columns.get(name, 'NULL')} AS {kind}) AS {name}"
            for name, kind in SOURCE_EVENTS.items()
        ]
    )


def web_shards(spark: SparkSession, sf_dir: str, event_name: str | None = None, spread: int | None = None) -> DataFrame:
    """``events`` as visits and purchases of a web shop.

    Naming one event here lets the filter reach the files, which a filter on
    the derived name cannot. The events named are about to be filtered by what
    ``props`` holds, so it is parsed behind a generator of one row: a filter
    does not move below a generator, where it would parse ``props`` again for
    every mention of ``k``. ``spread`` deals the flat events over so many tasks
    before they are widened, as in ``order_shards``.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if spread:
        events = events.repartition(spread)
    named = "event_type"
    for old, new in EVENT_NAMES.items():
        named = f"IF(event_type = '{old}', '{new}', {named})"
    if event_name is not None:
        stored = {new: old for old, new in EVENT_NAMES.items()}.get(event_name, event_name)
        events = events.where(events["event_type"] == stored)
        named = f"'{event_name}'"
    k = "CAST(get_json_object(props, '$.k') AS bigint)"
    if event_name is not None:
        events = events.selectExpr("*", f"explode(array({k})) AS parsed")
        k = "parsed"
    rows = events.selectExpr(
        "event_id",
        "user_id",
        "event_type = 'purchase' AS bought",
        f"{named} AS event_name",
        "value",
        "date_format(CAST(ts AS timestamp_ntz), 'yyyyMMdd') AS day",
        f"{_micros('CAST(ts AS timestamp_ntz)')} AS micros",
        f"{k} AS k",
    )
    items = ", ".join(
        _record(
            ITEM,
            item_id=f"user_id * 7 + {i * 13} + k",
            item_name=f"'item ' || (user_id + {i}) % 50",
            item_category="'category ' || k % 5",
            price_in_usd="value",
            quantity=str(i + 1),
            item_revenue_in_usd="value",
        )
        for i in range(3)
    )
    return _as_source(
        rows,
        event_date="day",
        event_name="event_name",
        event_timestamp="micros",
        event_bundle_sequence_id="IF(event_id % 7 <> 0, event_id, NULL)",
        user_pseudo_id="user_id * 8 + k % 8",
        user_id="IF(k % 5 = 0, 'member ' || user_id, NULL)",
        user_first_touch_timestamp="micros - k * 1000000",
        event_params=_params(
            "event_id % 101 = 0",
            _param("ga_session_id", int_value=f"floor(micros / {SESSION_BLOCK})"),
            _param("ga_session_number", int_value="k"),
            _param("page_location", "k % 10 <> 0", string_value="'/k/' || k"),
            _param("page_title", "k % 6 = 0", string_value="'Page ' || k"),
            _param("session_engaged", string_value="k % 2"),
            _param("engaged_session_event", "k % 4 = 1", int_value="1"),
            _param("currency", "bought AND k % 3 <> 0", string_value="'USD'"),
            _param("tax", "bought", float_value="value"),
            _param("coupon", "bought AND k % 7 = 0", string_value="'SAVE7'"),
        ),
        ecommerce=_record(
            ECOMMERCE,
            total_item_quantity="k % 4",
            purchase_revenue_in_usd="value",
            refund_value_in_usd="IF(k % 20 = 0, value, NULL)",
            shipping_value_in_usd="IF(k % 4 = 0, 4.5, NULL)",
            unique_items="k % 4",
            transaction_id="IF(k % 50 <> 0, user_id * 100 + k, NULL)",
        ),
        traffic_source=_record(
            TRAFFIC_SOURCE,
            medium="IF(k % 2 = 0, 'organic', 'referral')",
            name="IF(k % 4 <> 3, 'campaign ' || k % 4, NULL)",
            source="'source ' || k % 4",
        ),
        device=_record(
            DEVICE,
            category="'device ' || k % 3",
            operating_system="'os ' || k % 4",
            language="IF(k % 9 <> 0, 'en-us', NULL)",
            web_info=_record(WEB_INFO, browser="'browser ' || k % 5"),
        ),
        geo=_record(
            GEO,
            country="'country ' || user_id % 25",
            region="'region ' || user_id % 50",
            city="IF(user_id % 10 <> 0, 'city ' || user_id % 75, NULL)",
        ),
        user_ltv=_record(USER_LTV, revenue="value", currency="'USD'"),
        platform="'WEB'",
        stream_id="1",
        privacy_info=_record(PRIVACY_INFO, analytics_storage="k % 2", uses_transient_token="'No'"),
        event_dimensions=_record(EVENT_DIMENSIONS, hostname="'shop.example.com'"),
        items=f"IF(bought AND k % 25 <> 0, slice(array({items}), 1, CAST(k % 4 AS int)), NULL)",
        source_table_suffix="day",
    )


def order_shards(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """``lineitem`` as purchases, one per order line, of a part and an add-on.

    The lines of an order share its transaction id and its buyer, so
    transaction ids repeat over events. ``spread`` deals the flat lines, of
    which only the columns in use go along, over so many tasks before they are
    widened. A file of few row groups needs it, since each is read by one task.
    """
    shipped = "CAST(l_shipdate AS timestamp_ntz)"
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if spread:
        lines = lines.repartition(spread)
    rows = lines.selectExpr(
        "*",
        f"date_format({shipped}, 'yyyyMMdd') AS day",
        f"{_micros(shipped)} + (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber) % {DAY}"
        " AS micros",
        "CAST(round(CAST(l_extendedprice AS decimal(18,6))"
        " * (1 - CAST(l_discount AS decimal(18,6))), 2) AS double) AS revenue",
    )
    refund = "IF(l_returnflag = 'R', revenue, NULL)"
    service_price = "IF(l_suppkey % 3 <> 0, (100 + l_suppkey % 50) / 10D, NULL)"
    goods = _record(
        ITEM,
        item_id="l_partkey",
        item_name="IF(l_partkey % 97 <> 0, 'part ' || l_partkey % 64, NULL)",
        item_brand="'Brand#' || l_partkey % 25",
        item_category="'type ' || l_partkey % 6",
        item_category2="IF(l_partkey % 4 <> 0, 'kind ' || l_suppkey % 9, NULL)",
        price_in_usd="(9000 + l_partkey % 1000) / 10D",
        quantity="l_quantity",
        item_revenue_in_usd="revenue",
        item_refund_in_usd=refund,
        coupon="IF(l_discount > 0.08D, 'BULK', NULL)",
    )
    add_on = _record(
        ITEM,
        item_id="'add-on ' || l_suppkey % 40",
        item_name="'service ' || l_suppkey % 10",
        item_category="'service'",
        price_in_usd=service_price,
        quantity="IF(l_suppkey % 7 <> 0, 1, NULL)",
        item_revenue_in_usd=service_price,
    )
    # A line has no array, an empty one, its part, or its part and an add-on.
    pieces = "IF(l_suppkey % 59 = 0, 0, IF(l_tax > 0.045D, 2, 1))"
    return _as_source(
        rows,
        event_date="day",
        event_name="IF(l_linenumber = 7, 'add_to_cart', 'purchase')",
        event_timestamp="micros",
        event_bundle_sequence_id="l_orderkey",
        user_pseudo_id="IF(l_orderkey % 211 <> 0, l_orderkey DIV 4, NULL)",
        event_params=_params(
            "l_partkey % 101 = 0",
            _param("ga_session_id", int_value=f"floor(micros / {SESSION_BLOCK})"),
            _param("currency", "l_partkey % 3 <> 0", string_value="'USD'"),
            _param("tax", float_value="l_tax"),
            _param("coupon", "l_discount > 0.08D", string_value="'BULK'"),
        ),
        ecommerce=_record(
            ECOMMERCE,
            total_item_quantity="l_quantity",
            purchase_revenue_in_usd="revenue",
            refund_value_in_usd=refund,
            transaction_id="IF(l_orderkey % 50 <> 0, l_orderkey, NULL)",
        ),
        geo=_record(GEO, country="'country ' || l_suppkey % 25"),
        items=f"IF(l_suppkey % 53 = 0, NULL, slice(array({goods}, {add_on}), 1, {pieces}))",
        source_table_suffix="day",
    )
