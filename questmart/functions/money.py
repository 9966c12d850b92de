"""Money and ratio expressions.

Amounts are decimals. A quotient is taken in DOUBLE, fixed to DECIMAL(38,6) and only then rounded, so sums stay
exact whatever the order of the rows and half-way cases round alike on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount(text: Column) -> Column:
    """Text to DECIMAL(38,3); NULL when it is no number."""
    return text.try_cast("decimal(38,3)")


def quotient(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as DECIMAL(38,6); NULL for a zero or NULL divisor. A value too wide for it fails."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")).cast("decimal(38,6)")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    return F.round(quotient(numerator, denominator), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")).cast("decimal(28,8)") * 100, digits)


def usd(local_amount: Column, units_per_usd: Column) -> Column:
    """Local money to USD cents by the rate table; a currency without a rate counts as USD."""
    return ratio(local_amount, F.coalesce(units_per_usd, F.lit(1.0)), 2)


def usd_at_event(local_amount: Column, event_rate: Column) -> Column:
    """USD cents by the rate stored in the event; a zero or missing rate gives NULL."""
    return ratio(local_amount, event_rate, 2)
