"""The run's clock, threshold and age arithmetic.

A run has one instant, ``as_of``; every comparison and every stamp uses it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3600 * MICROS_PER_SECOND


def resolve_as_of(as_of: datetime | None = None) -> datetime:
    """The run's instant: now unless given.  A naive datetime means UTC."""
    if as_of is None:
        return datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        return as_of.replace(tzinfo=timezone.utc)
    return as_of


def instant(as_of: datetime) -> Column:
    """``as_of`` as a timestamp literal, independent of the session time zone."""
    moment = resolve_as_of(as_of)
    seconds = int(moment.replace(microsecond=0).timestamp())
    return F.timestamp_micros(F.lit(seconds * MICROS_PER_SECOND + moment.microsecond))


def epoch() -> Column:
    return F.timestamp_micros(F.lit(0))


def threshold_instant(as_of: Column, hours: int | Column) -> Column:
    """The oldest instant that still counts as fresh: strictly older is stale.

    Counted in microseconds: subtracting an interval would move whole days by
    the session zone's calendar, where a day need not have 24 hours.
    """
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.timestamp_micros(F.unix_micros(as_of) - hours.cast("bigint") * F.lit(MICROS_PER_HOUR))


def age_hours(as_of: Column, observed: Column) -> Column:
    """Hours since ``observed``, two decimals, exact and half away from zero.

    Negative for a future instant, NULL for an unknown one.
    """
    micros = F.unix_micros(as_of) - F.unix_micros(observed)
    return F.round(micros.cast("decimal(20,0)") / F.lit(MICROS_PER_HOUR).cast("decimal(10,0)"), 2).cast(
        "decimal(18,2)"
    )


def fixed_digits(value: Column, digits: int) -> Column:
    """Text of a double with a fixed number of decimals and no grouping.

    Rounds the exact binary value, ties to even, which is how a double prints
    with ``%.Nf`` in C and its descendants.
    """
    pattern = "0." + "0" * digits
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def float_age_hours(as_of: Column, observed: Column) -> Column:
    """Hours since ``observed`` computed in binary floating point.

    The cluster and table checks are defined over doubles; this differs from
    :func:`age_hours` only at exact ties (multiples of 18 seconds).
    """
    micros = F.unix_micros(as_of) - F.unix_micros(observed)
    hours = micros.cast("double") / F.lit(float(MICROS_PER_SECOND)) / F.lit(3600.0)
    return fixed_digits(hours, 2).cast("decimal(18,2)")


def whole_days(hours: int | Column) -> Column:
    """A threshold in whole days, rounded down."""
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.floor(hours / F.lit(24))


def age_days_label(age: Column) -> Column:
    """Age in days with one decimal; ``?`` where the age is unknown or zero."""
    days = age.cast("double") / F.lit(24.0)
    return F.when(age.isNull() | (age == 0), F.lit("?")).otherwise(fixed_digits(days, 1))
