"""Surrogate keys: md5 over the parts, joined without a separator.

The byte layout is part of the data contract, so parts ('1', '23') and
('12', '3') give the same key and a missing bundle number hashes like a zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(part: Column | str, missing: str = "") -> Column:
    part = F.col(part) if isinstance(part, str) else part
    return F.coalesce(part.cast("string"), F.lit(missing))


def event_key(
    event_date="event_date",
    user="user_pseudo_id",
    timestamp="event_timestamp",
    name="event_name",
    bundle="event_bundle_sequence_id",
) -> Column:
    return F.md5(
        F.concat(_text(event_date), _text(user), _text(timestamp), _text(name), _text(bundle, "0"))
    )


def item_key(
    position: Column | str,
    event_date="event_date",
    transaction="transaction_id",
    user="user_pseudo_id",
    timestamp="event_timestamp",
) -> Column:
    return F.md5(
        F.concat(
            _text(event_date),
            _text(transaction),
            _text(user),
            _text(timestamp),
            _text(position, "0"),
        )
    )


def session_key(user="user_pseudo_id", session_id="ga_session_id") -> Column:
    return F.md5(F.concat(_text(user), _text(session_id)))
