"""Day suffixes and week bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days between Monday and the first day of the week.
WEEK_STARTS = {"monday": 0, "sunday": 1}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_suffix(value: Column | str) -> Column:
    """'20240131' to a date; malformed text raises."""
    return F.to_date(_col(value), "yyyyMMdd")


def day_suffix(value: Column | str) -> Column:
    """A date to '20240131'."""
    return F.date_format(_col(value), "yyyyMMdd")


def week_start(day: Column | str, first_day: str = "monday") -> Column:
    """First day of the week a date falls in."""
    shift = WEEK_STARTS[first_day]
    if shift == 0:
        return F.trunc(_col(day), "week")
    return F.date_sub(F.trunc(F.date_add(_col(day), shift), "week"), shift)


def week_end(start: Column | str) -> Column:
    return F.date_add(_col(start), 6)


def from_micros(value: Column | str) -> Column:
    return F.timestamp_micros(_col(value))
