"""Parsing of monitoring items: names, timestamps, clocks.

Everything here is a native column expression; untrusted text that does not
parse becomes NULL (or an empty table name) and never fails the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters counted as blanks, the item name format and the
# accepted value formats.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Flags: i = any letter case, d = "." stops at \n only, U = Unicode blanks.
ITEM_NAME_PATTERN = r"(?idU)^Table\s+\[(.+?)\]:\s+Last\s+data\s+timestamp\s+\((.+?)\)$"

# ISO 8601 date, week date, time and zone, with or without separators.  One character
# of any kind stands between date and time, and one may stand before the zone unless
# there is a fraction of fewer than six digits.
ISO_DATE = r"(?!0000)(\d{4})(?:-(\d\d)-(\d\d)|(\d\d)(\d\d)|-W(\d\d)(?:-(\d))?|W(\d\d)(\d)?)"
ISO_TIME = (
    r"([01]\d|2[0-3])(?::([0-5]\d)(?::([0-5]\d)(?:[.,](\d+))?)?|([0-5]\d)(?:([0-5]\d)(?:[.,](\d+))?)?)?"
)
ISO_ZONE = (
    r"(?:(?<![.,]\d{1,5})\D)?(?:Z|([+-])([01]\d|2[0-3])"
    r"(?::([0-5]\d)(?::([0-5]\d)(?:[.,](\d+))?)?|([0-5]\d)(?:([0-5]\d)(?:[.,](\d+))?)?)?)"
)
MONTH = r"(0?[1-9]|1[0-2])"
DAY = r"(0?[1-9]|[12]\d|3[01])"
HOUR_12 = r"(0?[1-9]|1[0-2])"
HOUR_24 = r"([01]?\d|2[0-3])"
SIXTIETH = r"[0-5]?\d"
MARKER = r"\s+[AaPp][Mm]"
YEAR_FIRST_12H = (
    rf"(?U)^(?!0000)\d{{4}}-{MONTH}-{DAY}\s+{HOUR_12}:{SIXTIETH}:{SIXTIETH}{MARKER}$",
    "yyyy-M-d h:m:s a",
)
YEAR_FIRST_24H = (
    rf"(?U)^(?!0000)\d{{4}}-{MONTH}-{DAY}\s+{HOUR_24}:{SIXTIETH}:{SIXTIETH}({MARKER})?$",
    "yyyy-M-d H:m:s",
)
YEAR_FIRST_MINUTES = (rf"(?U)^(?!0000)\d{{4}}-{MONTH}-{DAY}\s+{HOUR_24}:{SIXTIETH}$", "yyyy-M-d H:m")
MONTH_FIRST_12H = (
    rf"(?U)^{MONTH}/{DAY}/(?!0000)\d{{4}}\s+{HOUR_12}:{SIXTIETH}:{SIXTIETH}{MARKER}$",
    "M/d/yyyy h:m:s a",
)

# Last second of the year 9999; larger numbers are not instants.
MAX_EPOCH_SECOND = 253_402_300_799


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def item_table(name: Column) -> Column:
    """Table part of a stripped item name, as written; empty if the name is of another form."""
    return F.coalesce(F.regexp_extract(name, ITEM_NAME_PATTERN, 1), F.lit(""))


def item_column(name: Column, table: Column) -> Column:
    """Column part of a stripped item name whose table part is ``table``.

    The pattern has run for the table: the column stands between the first bracket
    behind the table and the last character.
    """
    after = F.locate("[", name) + F.length(table)
    start = F.call_function("locate", F.lit("("), name, after + 1) + 1
    return F.when(table != "", F.substring(name, start, F.length(name) - start)).otherwise(F.lit(""))


# The one ISO shape nearly all values have: seconds, at most six digits of fraction, a zone below 18 hours.
PLAIN = r"^(?!0000)\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d:\d\d(?:[.,]\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?)?$"
ISO = rf"(?s)^{ISO_DATE}(?:.{ISO_TIME}(?:{ISO_ZONE})?)?$"
# What the groups of ISO hold, in the order of the split text below.
ISO_PARTS = (
    ("year", "$1"), ("month", "$2$4"), ("day", "$3$5"), ("week", "$6$8"), ("weekday", "$7$9"),
    ("hour", "$10"), ("minute", "$11$14"), ("second", "$12$15"), ("fraction", "$13$16"),
    ("sign", "$17"), ("zone_hour", "$18"), ("zone_minute", "$19$22"), ("zone_second", "$20$23"),
    ("zone_fraction", "$21$24"),
)
PLACES = {name: k + 1 for k, (name, _) in enumerate(ISO_PARTS)}


def _plain(text: Column) -> Column:
    """Instant of a text of the PLAIN shape; no zone means UTC."""
    size = F.length(text)
    # A zone ends in Z, or has its sign six characters before the end.
    zoned = (F.substring(text, -1, 1) == "Z") | F.substring(text, -6, 1).isin("+", "-")
    whole = F.when(size == 10, F.concat(text, F.lit("T00:00:00Z")))
    whole = whole.when(zoned, F.translate(text, ",", ".")).otherwise(F.concat(F.translate(text, ",", "."), F.lit("Z")))
    return whole.try_cast("timestamp")


def _iso_parts(text: Column) -> Column:
    """The parts of an ISO text of any form, behind a mark; a text that is none has no mark."""
    marked = F.regexp_replace(text, ISO, "\x01|" + "|".join(groups for _, groups in ISO_PARTS))
    return F.split(marked, r"\|")


def _iso_fields(parts: Column) -> dict[str, Column]:
    """The parts as numbers; NULL for all of them if the text is not ISO."""

    def number(name: str, default: int) -> Column:
        digits = F.get(parts, F.lit(PLACES[name]))
        return F.when(F.length(digits) > 0, digits.cast("int")).otherwise(default)

    def micros(name: str) -> Column:
        return F.rpad(F.substring(F.get(parts, F.lit(PLACES[name])), 1, 6), 6, "0").cast("bigint")

    week = number("week", -1)
    zone = number("zone_hour", 0).cast("bigint") * 3600 + number("zone_minute", 0) * 60 + number("zone_second", 0)
    zone = zone * 1_000_000 + micros("zone_fraction")
    return {
        "local": F.try_make_timestamp(
            number("year", 0),
            F.when(week < 0, number("month", 0)).otherwise(1),
            F.when(week < 0, number("day", 0)).otherwise(4),
            number("hour", 0), number("minute", 0),
            number("second", 0).cast("decimal(8,6)"), F.lit("UTC"),
        ),
        "year": number("year", 0),
        "week": week,
        "weekday": number("weekday", 1),
        # Microseconds from the written time to UTC, and those below the second.
        "shift": micros("fraction") - F.when(F.get(parts, F.lit(PLACES["sign"])) == "-", -zone).otherwise(zone),
    }


def _iso_instant(fields: Column) -> Column:
    """Instant of ISO fields; a fraction of any length was cut to microseconds, no zone means UTC."""
    local, week, weekday = fields["local"], fields["week"], fields["weekday"]
    # Week 1 has the 4th of January in it; weeks begin on Monday.
    epoch_day = F.floor(F.unix_micros(local) / 86_400_000_000)
    monday = epoch_day - F.pmod(epoch_day + 3, F.lit(7))
    days = monday - epoch_day + (week - 1) * 7 + weekday - 1
    # Thursday decides which year a week belongs to.
    thursday = F.date_add(F.lit("1970-01-01").cast("date"), (epoch_day + days - weekday + 4).cast("int"))
    right_week = (week > 0) & weekday.between(1, 7) & (F.year(thursday) == fields["year"])
    right_week = right_week & (epoch_day + days <= MAX_EPOCH_SECOND // 86_400)
    by_date = F.timestamp_micros(F.unix_micros(local) + fields["shift"])
    by_week = F.timestamp_micros(F.unix_micros(local) + days.cast("bigint") * 86_400_000_000 + fields["shift"])
    return F.when(week < 0, by_date).when(right_week, by_week)


def _formatted(text: Column, shape: tuple[str, str], drop_marker: bool = False) -> Column:
    """Instant of a text in one of the formats above, read as UTC."""
    pattern, layout = shape
    spaced = F.regexp_replace(text, r"(?U)\s+", " ")
    if drop_marker:
        spaced = F.regexp_replace(spaced, r" [AaPp][Mm]$", "")
    utc = F.concat(spaced, F.lit(" Z"))
    # The shape test comes first and is strict about ranges: every rejection by
    # the parser costs an exception with a formatted message.
    return F.when(text.rlike(pattern), F.try_to_timestamp(utc, F.lit(layout + " X")))


# Shapes of values, told apart by cheap tests.
DIGITS, PLAIN_SHAPE, ISO_SHAPE, OTHER_SHAPE = range(4)


def with_instants(frame: DataFrame, text: str, output: str) -> DataFrame:
    """``frame`` with the instant of a text column without surrounding blanks as ``output``.

    NULL if the text is empty or in no accepted format.  Formats, first match wins:
    epoch seconds; ISO date or week date, compact or not, with optional time,
    fraction of any length and zone; ``2026-06-10 12:55:00 AM`` on a 12 h clock, or on
    a 24 h clock where the marker is ignored; 24 h to the second or minute;
    ``06/10/2026 01:05:00 PM``.  No zone means UTC.

    Three projections, as a part that is used several times is a column of the one
    before: the shape of the text, the fields of those ISO texts that are not plain,
    and the instant.  Spark compiles each, and what a shape does not need is not
    computed.
    """
    value, columns = F.col(text), frame.columns
    shape = (
        F.when(value.rlike("^[0-9]{1,18}$"), DIGITS)
        .when(value.rlike(PLAIN), PLAIN_SHAPE)
        .when(value.rlike("^[0-9]{4}[-0-9W]"), ISO_SHAPE)
        .otherwise(OTHER_SHAPE)
    )
    kind = F.col("_shape")
    shaped = frame.select("*", shape.alias("_shape"))
    split = shaped.select("*", F.when(kind == ISO_SHAPE, _iso_parts(value)).alias("_parts"))
    is_iso = F.get("_parts", F.lit(0)) == "\x01"
    fields = F.struct(*[column.alias(name) for name, column in _iso_fields(F.col("_parts")).items()])
    typed = split.select("*", F.when(is_iso, fields).alias("_fields"))
    seconds = value.try_cast("bigint")
    other = F.coalesce(
        _formatted(value, YEAR_FIRST_12H),
        _formatted(value, YEAR_FIRST_24H, drop_marker=True),
        _formatted(value, YEAR_FIRST_MINUTES),
        _formatted(value, MONTH_FIRST_12H),
    )
    instant = (
        F.when(kind == DIGITS, F.when(seconds <= F.lit(MAX_EPOCH_SECOND), F.timestamp_seconds(seconds)))
        .when(kind == PLAIN_SHAPE, _plain(value))
        .when(F.col("_fields").isNotNull(), F.coalesce(_iso_instant(F.col("_fields")), other))
        .otherwise(other)
    )
    return typed.select(*columns, instant.alias(output))


def parse_clock(value: Column) -> Column:
    """Whole number of an item's clock; NULL if it is none."""
    # A failing cast is an exception inside, hence the test.
    return F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), value.try_cast("bigint"))
