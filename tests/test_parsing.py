import random
from datetime import datetime, timezone

import pytest
from conftest import AS_OF, at
from pyspark.sql import functions as F

from tidemark.functions import ages, labels, parsing
from tidemark.operators.items import with_item_parts


def evaluate(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def instants(spark, texts):
    """Microseconds since 1970 of each text."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    values = rows.select("i", parsing.strip_blanks(F.col("t")).alias("t"))
    found = parsing.with_instants(values, "t", "at")
    assert found.columns == ["i", "t", "at"]
    return [r[0] for r in found.orderBy("i").select(F.unix_micros("at")).collect()]


VALUES = {
    "2026-06-10 12:55:00": "2026-06-10 12:55:00",
    "2026-06-10T12:55:00.000Z": "2026-06-10 12:55:00",
    "2026-06-10 12:55:00 AM": "2026-06-10 00:55:00",
    "2026-06-10 14:55:00 AM": "2026-06-10 14:55:00",
    "2026-06-10 00:05:00 PM": "2026-06-10 00:05:00",
    "2026-6-1 1:5:0 pm": "2026-06-01 13:05:00",
    "06/10/2026 01:05:00 PM": "2026-06-10 13:05:00",
    "6/1/2026  1:05:00   PM": "2026-06-01 13:05:00",
    "2026-06-10 12:55:00+03:00": "2026-06-10 09:55:00",
    "2026-06-10 12:55+03:00": "2026-06-10 09:55:00",
    "2026-06-10T12:55Z": "2026-06-10 12:55:00",
    "2026-06-10 12:55:00,5": "2026-06-10 12:55:00.5",
    "2026-06-10T12:55:00.123456-02:30": "2026-06-10 15:25:00.123456",
    "2026-06-10": "2026-06-10 00:00:00",
    "2026-06-10 12:55": "2026-06-10 12:55:00",
    "2026-6-1 9:05": "2026-06-01 09:05:00",
    "2026-6-1 9:05:00": "2026-06-01 09:05:00",
    " \t2026-06-10  ": "2026-06-10 00:00:00",
    "1718000100": "2024-06-10 06:15:00",
    "20260610": "1970-08-23 11:56:50",
    "0": "1970-01-01 00:00:00",
    "253402300799": "9999-12-31 23:59:59",
    "253402300800": None,
    "1718000100000": None,
    "99999999999999999999": None,
    "2026-06": None,
    "T12:55": None,
    "-5": None,
    "garbage": None,
    "2026-02-30": None,
    "2026-06-10 25:00:00": None,
    "2026-06-10 13:00:00 XM": None,
    "13/10/2026 01:05:00 PM": None,
    "06/10/2026 13:05:00 PM": None,
    "": None,
    "   ": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = instants(spark, list(VALUES))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    start = datetime(1970, 1, 1)
    expected = [
        None if v is None else round((datetime.fromisoformat(v) - start).total_seconds() * 1_000_000) for v in VALUES.values()
    ]
    assert dict(zip(VALUES, micros)) == dict(zip(VALUES, expected))


NAMES = {
    "Table [ibm_vios_general]: Last data timestamp (time)": ("ibm_vios_general", "time"),
    "  table  [a]:  LAST DATA  timestamp (b) ": ("a", "b"),
    "Table [ a b ]: Last data timestamp ( c )": ("a b", "c"),
    "Table [a]: Last data timestamp (b) (c)": ("a", "b) (c"),
    "Table [a]: Last data timestamp (b)\n": ("a", "b"),
    "Table [a] Last data timestamp (b)": ("", ""),
    "Table []: Last data timestamp (b)": ("", ""),
    "Table [ ]: Last data timestamp (t)": ("", "t"),
    "Table [a]: Last data timestamp ( )": ("a", ""),
    "x Table [a]: Last data timestamp (b)": ("", ""),
    "Table [a[(b]: c]:\u2003Last data\ttimestamp  (d(e)": ("a[(b]: c", "d(e"),
    "TABLE\t[(]: Last data timestamp (()": ("(", "("),
    "": ("", ""),
    None: ("", ""),
}


def test_item_names(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "name string")
    found = {r["name"]: (r["table_name"], r["column_name"]) for r in with_item_parts(rows).collect()}
    assert found == NAMES


def test_clocks(spark):
    clocks = {"1718000100": 1718000100, " 12 ": 12, "-3": -3, "abc": None, "1.5": None, "": None, None: None}
    assert dict(zip(clocks, evaluate(spark, list(clocks), parsing.parse_clock))) == clocks


def test_exact_ages(spark):
    now = ages.instant(AS_OF)
    seconds = {18: "0.01", 54: "0.02", 17: "0.00", 3600: "1.00", -18: "-0.01", 604800: "168.00", 604817: "168.00", 604818: "168.01"}
    times = [AS_OF.timestamp() - s for s in seconds]
    got = evaluate(spark, times, lambda v: ages.age_hours(now, F.timestamp_seconds(v)), "double")
    assert [str(g) for g in got] == list(seconds.values())
    assert evaluate(spark, [None], lambda v: ages.age_hours(now, F.timestamp_seconds(v)), "double") == [None]


def test_float_ages_round_like_floats(spark):
    now = ages.instant(AS_OF)
    seconds = [18, 54, 90, 126, 162, 17, 3600, -18, 604818, 1234567]
    times = [AS_OF.timestamp() - s for s in seconds]
    got = evaluate(spark, times, lambda v: ages.float_age_hours(now, F.timestamp_seconds(v)), "double")
    assert [float(g) for g in got] == [round(s / 3600, 2) for s in seconds]


def test_labels_round_like_floats(spark):
    hours = [0.25, 0.35, 1.2, 3.6, 24.0, 167.95, 12345.65, 1234567.89]
    assert evaluate(spark, hours, labels.age_label, "double") == [f"({h:.1f}h)" for h in hours]
    assert evaluate(spark, [None], labels.age_label, "double") == [""]
    assert evaluate(spark, hours, ages.age_days_label, "double") == [str(round(h / 24, 1)) for h in hours]
    assert evaluate(spark, [None, 0.0], ages.age_days_label, "double") == ["?", "?"]
    assert evaluate(spark, [168, 72, 23], ages.whole_days, "int") == [7, 3, 0]


def test_stale_tables(spark):
    assert evaluate(spark, [168.0, 168.01, None, 0.0], labels.is_stale_table, "double") == [False, True, False, False]


def test_threshold_ignores_the_session_zone(spark):
    """Hours are absolute, also across a clock change."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        limit = ages.threshold_instant(ages.instant(at("2026-03-09T00:00:00")), 48)
        assert spark.range(1).select(F.unix_seconds(limit)).first()[0] == at("2026-03-07T00:00:00").timestamp()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def iso_texts():
    """ISO texts of every kind, some of them wrong in one place."""
    rng = random.Random(3)
    for _ in range(3000):
        year, dash, colon = rng.choice([2026, 2020, 1969, 1, 9999, 2024, 0]), rng.choice(["-", ""]), rng.choice([":", ""])
        if rng.random() < 0.7:
            text = f"{year:04d}{dash}{rng.choice([1, 2, 6, 12, 13]):02d}{dash}{rng.choice([1, 28, 29, 31]):02d}"
        else:
            text = f"{year:04d}{dash}W{rng.choice([0, 1, 24, 52, 53, 54]):02d}" + rng.choice(["", dash + rng.choice("13780")])
        if rng.random() < 0.85:
            parts = [f"{rng.choice([0, 12, 23, 24]):02d}", f"{rng.choice([0, 55, 60]):02d}", f"{rng.choice([0, 59, 60]):02d}"]
            kept = rng.randint(1, 3)
            text += rng.choice("T x") + colon.join(parts[:kept])
            if kept == 3 and rng.random() < 0.5:
                text += rng.choice(".,") + "".join(rng.choices("0123456789", k=rng.choice([1, 3, 6, 7, 9])))
            if rng.random() < 0.6:
                zones = ["Z", "+03", "-0330", "-03:30", "+03:00:30", "+030030.5", "+24", "+23:59", "z", "+3"]
                text += rng.choice([""] * 5 + [" "]) + rng.choice(zones)
        yield text


def test_iso_values_as_the_standard_library(spark):
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    want = {}
    for text in set(iso_texts()):
        try:
            value = datetime.fromisoformat(text)
            since = value.replace(tzinfo=value.tzinfo or timezone.utc) - start
            want[text] = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
        except (ValueError, OverflowError):
            want[text] = None
    texts = [t for t in want if not t.isdigit()]  # digits alone are epoch seconds
    got = dict(zip(texts, instants(spark, texts)))
    assert {t: (got[t], want[t]) for t in texts if got[t] != want[t]} == {}
    assert sum(v is not None for v in want.values()) > 300
