"""Declared columns of the source shards, the raw tables and the run ledger.

Fixed values: the names, order and types are those of the data itself. Each
table or struct is a mapping of field name to type; ``ddl`` and ``struct_type``
turn it into text for a reader or a cast.
"""

from __future__ import annotations


def struct_type(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields.items()) + ">"


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


PARAM_VALUE = {
    "string_value": "string",
    "int_value": "bigint",
    "float_value": "double",
    "double_value": "double",
}
PARAM = {"key": "string", "value": struct_type(PARAM_VALUE)}

USER_PROPERTY_VALUE = {
    "string_value": "bigint",
    "int_value": "bigint",
    "float_value": "bigint",
    "double_value": "bigint",
    "set_timestamp_micros": "bigint",
}
USER_PROPERTY = {"key": "bigint", "value": struct_type(USER_PROPERTY_VALUE)}

ECOMMERCE = {
    "total_item_quantity": "bigint",
    "purchase_revenue_in_usd": "double",
    "purchase_revenue": "double",
    "refund_value_in_usd": "double",
    "refund_value": "double",
    "shipping_value_in_usd": "double",
    "shipping_value": "double",
    "tax_value_in_usd": "double",
    "tax_value": "double",
    "unique_items": "bigint",
    "transaction_id": "string",
}

TRAFFIC_SOURCE = {"medium": "string", "name": "string", "source": "string"}

WEB_INFO = {"browser": "string", "browser_version": "string"}

DEVICE = {
    "category": "string",
    "mobile_brand_name": "string",
    "mobile_model_name": "string",
    "mobile_marketing_name": "string",
    "mobile_os_hardware_model": "bigint",
    "operating_system": "string",
    "operating_system_version": "string",
    "vendor_id": "bigint",
    "advertising_id": "bigint",
    "language": "string",
    "is_limited_ad_tracking": "string",
    "time_zone_offset_seconds": "bigint",
    "web_info": struct_type(WEB_INFO),
}

GEO = {
    "continent": "string",
    "sub_continent": "string",
    "country": "string",
    "region": "string",
    "city": "string",
    "metro": "string",
}

USER_LTV = {"revenue": "double", "currency": "string"}

PRIVACY_INFO = {
    "analytics_storage": "bigint",
    "ads_storage": "bigint",
    "uses_transient_token": "string",
}

APP_INFO = {
    "id": "string",
    "version": "string",
    "install_store": "string",
    "firebase_app_id": "string",
    "install_source": "string",
}

EVENT_DIMENSIONS = {"hostname": "string"}

ITEM = {
    "item_id": "string",
    "item_name": "string",
    "item_brand": "string",
    "item_variant": "string",
    "item_category": "string",
    "item_category2": "string",
    "item_category3": "string",
    "price_in_usd": "double",
    "price": "double",
    "quantity": "bigint",
    "item_revenue_in_usd": "double",
    "item_revenue": "double",
    "item_refund_in_usd": "double",
    "item_refund": "double",
    "coupon": "string",
    "affiliation": "string",
    "item_list_id": "string",
    "item_list_name": "string",
    "item_list_index": "string",
    "promotion_id": "string",
    "promotion_name": "string",
    "creative_name": "string",
    "creative_slot": "string",
}

# What a source event and a raw event have in common.
EVENT = {
    "event_name": "string",
    "event_timestamp": "bigint",
    "event_bundle_sequence_id": "bigint",
    "user_pseudo_id": "string",
    "user_id": "string",
    "user_first_touch_timestamp": "bigint",
    "event_params": f"array<{struct_type(PARAM)}>",
    "user_properties": f"array<{struct_type(USER_PROPERTY)}>",
    "ecommerce": struct_type(ECOMMERCE),
    "traffic_source": struct_type(TRAFFIC_SOURCE),
    "device": struct_type(DEVICE),
    "geo": struct_type(GEO),
    "user_ltv": struct_type(USER_LTV),
    "platform": "string",
    "stream_id": "bigint",
    "privacy_info": struct_type(PRIVACY_INFO),
    "app_info": struct_type(APP_INFO),
    "event_dimensions": struct_type(EVENT_DIMENSIONS),
}

SOURCE_EVENTS = {
    "event_date": "string",
    **EVENT,
    "items": f"array<{struct_type(ITEM)}>",
    "source_table_suffix": "string",
}

RAW_EVENTS = {
    "event_date_dt": "date",
    "event_id": "string",
    **EVENT,
    "ingested_at": "timestamp",
    "source_table_suffix": "string",
}

RAW_PURCHASE_ITEMS = {
    "event_date_dt": "date",
    "item_event_id": "string",
    "event_id": "string",
    "transaction_id": "string",
    "user_pseudo_id": "string",
    "item_position": "bigint",
    **ITEM,
    "ingested_at": "timestamp",
    "source_table_suffix": "string",
}

PIPELINE_RUNS = {
    "run_id": "string not null",
    "run_date": "date",
    "layer": "string",
    "status": "string",
    "rows_processed": "bigint",
    "error_message": "string",
    "started_at": "timestamp",
    "completed_at": "timestamp",
    "duration_seconds": "double",
}
