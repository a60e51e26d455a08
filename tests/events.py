"""Hand-written source events."""

from __future__ import annotations

from datetime import datetime, timezone

from shopgauge.schemas import SOURCE_EVENTS, ddl


def micros(day: str, time: str = "12:00:00") -> int:
    moment = datetime.strptime(day + time, "%Y%m%d%H:%M:%S").replace(tzinfo=timezone.utc)
    return int(moment.timestamp()) * 1_000_000


def _value(value) -> dict:
    if isinstance(value, str):
        return {"string_value": value}
    if isinstance(value, float):
        return {"float_value": value}
    return {"int_value": value}


def event(name: str, day: str, user: str | None, time: str = "12:00:00", params=None, **more) -> dict:
    """One event; ``params`` is a dict, a list of pairs (keys may repeat) or None."""
    pairs = list(params.items()) if isinstance(params, dict) else (params or [])
    return {
        "event_date": day,
        "event_name": name,
        "event_timestamp": micros(day, time),
        "user_pseudo_id": user,
        "event_params": [{"key": k, "value": _value(v)} for k, v in pairs],
        "source_table_suffix": day,
        **more,
    }


def visit(day: str, user: str | None, session=1, time: str = "12:00:00", params=None, **more) -> dict:
    given = {} if session is None else {"ga_session_id": session}
    return event("session_start", day, user, time, {**given, **(params or {})}, **more)


def purchase(
    day: str,
    user: str | None,
    transaction: str | None,
    revenue: float | None = 10.0,
    refund: float | None = None,
    time: str = "13:00:00",
    params=(("ga_session_id", 1),),
    items=None,
    **more,
) -> dict:
    return event(
        "purchase",
        day,
        user,
        time,
        list(params),
        ecommerce={
            "transaction_id": transaction,
            "purchase_revenue_in_usd": revenue,
            "refund_value_in_usd": refund,
        },
        items=items,
        **more,
    )


def shards(spark, rows: list[dict]):
    return spark.createDataFrame(rows, ddl(SOURCE_EVENTS))


def rows_of(df, *columns) -> list[tuple]:
    frame = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in frame.collect()), key=repr)
