"""Hand-written edge cases of the raw and staging operators."""

from __future__ import annotations

from datetime import date, datetime

from events import event, micros, purchase, rows_of, shards, visit
from shopgauge.operators import quality, raw, staging


def staged(spark, rows):
    source = shards(spark, rows)
    events = raw.raw_events(source)
    return events, staging.purchase_items(raw.raw_purchase_items(source))


def sessions(spark, rows):
    return staging.sessions(staged(spark, rows)[0])


def purchases(spark, rows):
    return staging.purchases(staged(spark, rows)[0])


def test_event_key_bytes(spark):
    import hashlib

    row = visit("20240101", "u")
    got = raw.raw_events(shards(spark, [row])).first()
    text = f"20240101u{micros('20240101')}session_start0"
    assert got.event_id == hashlib.md5(text.encode()).hexdigest()
    assert got.event_date_dt == date(2024, 1, 1)


def test_missing_bundle_hashes_like_zero(spark):
    rows = [visit("20240101", "u"), visit("20240101", "u", event_bundle_sequence_id=0)]
    assert raw.raw_events(shards(spark, rows)).select("event_id").distinct().count() == 1


def test_session_over_midnight_is_one(spark):
    rows = [
        visit("20240101", "u", 5, "23:59:00", {"page_location": "/first"}),
        visit("20240102", "u", 5, "00:10:00", {"page_location": "/second"}),
    ]
    (row,) = sessions(spark, rows).collect()
    assert (row.session_date, row.landing_page) == (date(2024, 1, 1), "/first")
    assert row.session_started_at == datetime(2024, 1, 1, 23, 59)


def test_same_moment_is_settled_by_event_id(spark):
    rows = [
        visit("20240101", "u", 5, params={"page_location": "/a"}, event_bundle_sequence_id=1),
        visit("20240101", "u", 5, params={"page_location": "/b"}, event_bundle_sequence_id=2),
    ]
    first = min(raw.raw_events(shards(spark, rows)).collect(), key=lambda r: r.event_id)
    wanted = "/a" if first.event_bundle_sequence_id == 1 else "/b"
    for order in (rows, rows[::-1]):
        assert sessions(spark, order).first().landing_page == wanted


def test_landing_page_is_the_first_known(spark):
    rows = [
        visit("20240101", "u", 5, "10:00:00"),
        visit("20240101", "u", 5, "11:00:00", {"page_location": "/known"}),
    ]
    assert sessions(spark, rows).first().landing_page == "/known"


def test_event_without_session_id(spark):
    titled = event("session_start", "20240101", "u", params={"page_title": "t"})
    numbered = event("session_start", "20240101", "v", params={"ga_session_number": 3})
    events, _ = staged(spark, [titled, numbered])
    assert staging.sessions(events).count() == 0
    users = staging.users(events, staging.purchases(events))
    assert rows_of(users, "user_pseudo_id", "total_sessions") == [("v", 1)]


def test_sign_in_does_not_split_a_session(spark):
    rows = [visit("20240101", "x", 1), visit("20240101", "x", 1, "12:30:00", user_id="u")]
    assert rows_of(sessions(spark, rows), "user_pseudo_id", "user_id") == [("x", "u")]


def test_repeated_key_gives_the_largest_value(spark):
    row = event("purchase", "20240101", "u", params=[("ga_session_id", 3), ("ga_session_id", 8)])
    row["ecommerce"] = {"transaction_id": "t"}
    assert purchases(spark, [row]).first().ga_session_id == 8


def test_engagement(spark):
    rows = [
        visit("20240101", "u", 1, params={"session_engaged": "1", "engaged_session_event": 1}),
        visit("20240101", "u", 2, params={"session_engaged": "0"}),
        visit("20240101", "u", 3),
    ]
    got = rows_of(sessions(spark, rows), "ga_session_id", "is_engaged", "engaged_event_count")
    assert got == [(1, True, 1), (2, False, 0), (3, False, 0)]


def test_purchase_without_transaction_is_no_order(spark):
    assert purchases(spark, [purchase("20240101", "u", None)]).count() == 0


def test_purchase_without_params_loses_order_but_keeps_items(spark):
    row = purchase("20240101", "u", "t", params=(), items=[{"item_id": "i", "item_name": "n"}])
    events, items = staged(spark, [row])
    orders = staging.purchases(events)
    assert orders.count() == 0
    assert items.count() == 1
    found = quality.relationships("fk", items, "event_id", orders, "event_id").first()
    assert found.failing_rows == 1


def test_missing_param_array_is_no_order(spark):
    row = purchase("20240101", "u", "t")
    row["event_params"] = None
    assert purchases(spark, [row]).count() == 0


def test_repeated_delivery_is_one_order(spark):
    row = purchase("20240101", "u", "t")
    assert purchases(spark, [row, dict(row)]).count() == 1


def test_differing_copies_keep_one_whole_row(spark):
    a = purchase("20240101", "u", "t", geo={"country": "A", "city": "z"})
    b = purchase("20240101", "u", "t", geo={"country": "B", "city": "a"})
    for order in ([a, b], [b, a]):
        (row,) = purchases(spark, order).collect()
        assert (row.country, row.city) == ("A", "z")


def test_currency_and_tax_defaults(spark):
    row = purchase("20240101", "u", "t")
    other = purchase("20240101", "v", "t", params=[("currency", "EUR"), ("tax", 1.5)])
    got = rows_of(purchases(spark, [row, other]), "user_pseudo_id", "currency", "tax_local")
    assert got == [("u", "USD", 0.0), ("v", "EUR", 1.5)]


def test_items_positions_and_inner_opening(spark):
    rows = [
        purchase("20240101", "u", "t", items=[{"item_id": "a"}, {"item_id": "b"}]),
        purchase("20240101", "v", "t", items=[]),
        purchase("20240101", "w", "t", items=None),
        event("add_to_cart", "20240101", "x", items=[{"item_id": "c"}]),
    ]
    items = raw.raw_purchase_items(shards(spark, rows))
    assert rows_of(items, "item_id", "item_position") == [("a", 0), ("b", 1)]


def test_item_money(spark):
    rows = [
        purchase(
            "20240101",
            "u",
            "t",
            items=[
                {"price_in_usd": 1.005, "quantity": 1, "item_revenue_in_usd": None},
                {"price_in_usd": None, "quantity": 2, "item_refund_in_usd": 3.0},
                {"price_in_usd": 2.0, "quantity": 0, "item_revenue_in_usd": 5.0},
            ],
        )
    ]
    _, items = staged(spark, rows)
    got = [
        tuple(r)
        for r in items.orderBy("item_position")
        .select("gross_revenue_usd", "item_revenue_usd", "item_refund_usd", "net_revenue_usd")
        .collect()
    ]
    assert got == [(1.01, 0.0, 0.0, 0.0), (None, 0.0, 3.0, -3.0), (0.0, 5.0, 0.0, 5.0)]


def test_items_of_purchase_without_transaction_stay_raw(spark):
    row = purchase("20240101", "u", None, items=[{"item_id": "a"}])
    assert raw.raw_purchase_items(shards(spark, [row])).count() == 1
    assert staged(spark, [row])[1].count() == 0


def test_users(spark):
    rows = [
        visit("20240101", "both", 1, traffic_source={"source": None}),
        visit("20240103", "both", 2, traffic_source={"source": "later"}),
        purchase("20240102", "both", "t1"),
        purchase("20240105", "both", "t2"),
        purchase("20240104", "buyer", "t3"),
        visit("20240101", None, 1, geo={"country": "X"}),
        purchase("20240101", None, "t4"),
    ]
    events, _ = staged(spark, rows)
    users = {r.user_pseudo_id: r for r in staging.users(events, staging.purchases(events)).collect()}
    assert set(users) == {"both", "buyer", None}
    both = users["both"]
    assert (both.first_seen_date, both.last_seen_date) == (date(2024, 1, 1), date(2024, 1, 3))
    assert (both.total_sessions, both.first_purchase_date) == (2, date(2024, 1, 2))
    assert both.acquisition_source is None  # the first visit's value, missing as it is
    assert users["buyer"].first_seen_date is None
    assert users["buyer"].first_purchase_date == date(2024, 1, 4)
    assert all(value is None for value in users[None])


def test_missing_session_id_counts_once_for_the_user(spark):
    rows = [
        visit("20240101", "u", None, "10:00:00", {"ga_session_number": 1}),
        visit("20240101", "u", None, "11:00:00", {"ga_session_number": 2}),
        visit("20240101", "u", 4, "12:00:00"),
    ]
    events, _ = staged(spark, rows)
    assert staging.users(events, staging.purchases(events)).first().total_sessions == 2


def test_universe_matches_users(spark):
    rows = [visit("20240101", "a"), purchase("20240101", "b", "t"), visit("20240101", None)]
    events, _ = staged(spark, rows)
    orders = staging.purchases(events)
    assert rows_of(staging.user_universe(events, orders)) == rows_of(
        staging.users(events, orders), "user_pseudo_id"
    )


def test_param_lookup_equals_pivot_by_grouping(spark):
    from pyspark.sql import functions as F

    from shopgauge.functions.params import param

    cases = [
        [],
        [("a", 1)],
        [("b", "x"), ("a", 2)],
        [("a", 2), ("a", 9), ("a", 4)],
        [("a", "text"), ("a", 4)],
        [("a", "text")],
        [("b", 1), ("b", 2), ("a", 7)],
    ]
    source = shards(
        spark,
        [event("e", "20240101", str(i), params=pairs) for i, pairs in enumerate(cases)],
    )
    ours = rows_of(source.select("user_pseudo_id", param("a", "int")))
    grouped = (
        source.select("user_pseudo_id", F.explode_outer("event_params").alias("p"))
        .groupBy("user_pseudo_id")
        .agg(F.max(F.when(F.col("p.key") == "a", F.col("p.value.int_value"))))
    )
    assert ours == rows_of(grouped)
