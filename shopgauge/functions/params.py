"""Event parameters read on the row.

A parameter is looked up with array functions instead of exploding the array
and grouping it back, so a pivot of any number of parameters needs no shuffle.
A key that repeats gives its largest value, a key that is absent gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def param(key: str, kind: str, params: str = "event_params") -> Column:
    """Value of ``key``; ``kind`` is ``string``, ``int``, ``float`` or ``double``.

    Keys seldom repeat within an event. While they do not, the value is read at
    the position of its key, which compiles; only events with repeated keys go
    through a lambda over all entries.
    """
    value = f"value.{kind}_value"
    no_repeats = f"size(array_distinct({params}.key)) = size({params})"
    at_position = f"get({params}.{value}, CAST(array_position({params}.key, '{key}') AS int) - 1)"
    largest = f"array_max(transform({params}, p -> IF(p.key = '{key}', p.{value}, NULL)))"
    return F.expr(f"IF({no_repeats}, {at_position}, {largest})")


def has_any_param(keys: tuple[str, ...], params: str = "event_params") -> Column:
    """True when one of ``keys`` is present; false for an empty or missing array."""
    wanted = ", ".join(f"'{key}'" for key in keys)
    return F.expr(f"coalesce(exists({params}, p -> p.key IN ({wanted})), false)")


def has_value(key: str, kind: str, params: str = "event_params") -> Column:
    """True when ``key`` is present with a value of its kind."""
    found = f"p -> p.key = '{key}' AND p.value.{kind}_value IS NOT NULL"
    return F.expr(f"coalesce(exists({params}, {found}), false)")


def has_params(params: str = "event_params") -> Column:
    return F.expr(f"coalesce(size({params}) > 0, false)")
