"""Column expressions for measures, money and time."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def outside(column: Column, low: float | None, high: float | None) -> Column:
    """True where a value lies beyond an open or closed range; NULL never violates."""
    checks = [column < F.lit(low)] if low is not None else []
    if high is not None:
        checks.append(column > F.lit(high))
    if not checks:
        return F.lit(False)
    return F.coalesce(checks[0] if len(checks) == 1 else checks[0] | checks[1], F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 where there is no whole."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def money(amount: Column) -> Column:
    """Two decimals, a tie going to the even cent; NULL for what money cannot hold."""
    return F.bround(amount, 2).try_cast("decimal(18,2)")


def measured(quantity: Column) -> Column:
    """A measured quantity as a decimal; NULL where it is no number or beyond 14 digits before the point."""
    return quantity.try_cast("decimal(22,8)")


def times_rate(quantity: Column, rate: str) -> Column:
    """An exact product of a measured quantity and a rate given as text."""
    return measured(quantity) * F.lit(Decimal(rate))


def hour_of(timestamp: Column) -> Column:
    return F.date_trunc("hour", timestamp)


def at_hour(date: Column, hour: int) -> Column:
    """The moment ``hour`` o'clock of a date."""
    return F.to_timestamp(date) + F.make_dt_interval(hours=F.lit(hour))
