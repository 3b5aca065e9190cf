"""Finding, source and report labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.ages import fixed_digits

MISSING = "MISSING"
STALE = "STALE"

# The table report's limit is a constant, not the run's threshold.
TABLE_STALE_HOURS = 168


def finding_label(missing: Column, stale: Column) -> Column:
    """MISSING wins over STALE; neither (or unknown) is NULL, meaning healthy."""
    return F.when(missing, F.lit(MISSING)).when(stale, F.lit(STALE))


def most_recent_observed(first: Column, second: Column) -> Column:
    """The later of two instants, either of which may be unknown."""
    return F.greatest(first, second)


def most_recent_source(first: Column, first_label: str, second: Column, second_label: str) -> Column:
    """Which source saw the record last; a tie goes to the first, NULL if neither did."""
    return (
        F.when(first.isNotNull() & (second.isNull() | (first >= second)), F.lit(first_label))
        .when(second.isNotNull(), F.lit(second_label))
    )


def is_stale_table(age: Column) -> Column:
    """Whether the table report marks a row; an unknown age is not stale."""
    return F.coalesce(age > F.lit(TABLE_STALE_HOURS), F.lit(False))


def timestamp_label(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))


def age_label(age: Column) -> Column:
    return F.coalesce(F.concat(F.lit("("), fixed_digits(age, 1), F.lit("h)")), F.lit(""))


def or_dash(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("-"))
