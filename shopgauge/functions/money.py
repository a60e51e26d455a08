"""Exact money.

Amounts arrive as doubles. They are added up as decimals, so a sum does not
depend on the order in which partitions arrive, and become doubles again only
after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount(value: Column | str) -> Column:
    """One amount as a decimal."""
    return _col(value).cast("decimal(18,6)")


def total(value: Column | str) -> Column:
    """An amount that is itself a total (a day's revenue) as a decimal."""
    return _col(value).cast("decimal(28,6)")


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(18,6)"))


def cents(value: Column) -> Column:
    """A decimal rounded to two places, as a double."""
    return F.round(value, 2).cast("double")


def round_half_up(value: Column, places: int) -> Column:
    """Round a double away from zero on ties, in plain double arithmetic."""
    factor = float(10**places)
    return F.signum(value) * F.floor(F.abs(value) * factor + 0.5) / F.lit(factor)


def ratio(numerator: Column | str, denominator: Column | str, places: int) -> Column:
    """Rounded quotient; NULL when the denominator is zero."""
    below = F.nullif(_col(denominator).cast("double"), F.lit(0.0))
    return round_half_up(_col(numerator).cast("double") / below, places)
