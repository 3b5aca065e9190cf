"""Monitoring items to table freshness rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.ages import float_age_hours, instant
from tidemark.functions.labels import is_stale_table
from tidemark.functions.parsing import item_column, item_table, parse_clock, strip_blanks, with_instants


def with_item_parts(items: DataFrame) -> DataFrame:
    """Items with ``table_name`` and ``column_name`` parsed from their name."""
    # Projections of their own: a part used twice would be worked out again otherwise.
    named = items.withColumn("_name", strip_blanks(F.col("name")))
    tabled = named.withColumn("_table", item_table(F.col("_name")))
    return tabled.withColumns(
        {
            "table_name": strip_blanks(F.col("_table")),
            "column_name": strip_blanks(item_column(F.col("_name"), F.col("_table"))),
        }
    ).drop("_name", "_table")


def parsed_items(items: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Items whose name parses, with their timestamp and clock.

    A value or clock that does not parse stays NULL; the item is kept.  ``counts``
    gets how many are ``parsed`` and ``skipped`` when the rows are written.
    """
    named = with_item_parts(items)
    if counts is not None:
        named = named.observe(counts, *_parse_counts())
    values = named.where(F.col("table_name") != "").select(
        "table_name",
        "column_name",
        F.col("itemid").alias("zabbix_item_id"),
        F.col("name").alias("zabbix_item_name"),
        strip_blanks(F.col("lastvalue")).alias("_value"),
        parse_clock(F.col("lastclock")).alias("last_clock"),
    )
    return with_instants(values, "_value", "last_data_timestamp").select(
        "table_name", "column_name", "zabbix_item_id", "zabbix_item_name", "last_data_timestamp", "last_clock"
    )


def item_parse_counts(items: DataFrame) -> DataFrame:
    """One row: how many items parse and how many are skipped."""
    return with_item_parts(items).agg(*_parse_counts())


def _parse_counts() -> list[Column]:
    skipped = F.col("table_name") == ""
    return [F.count_if(~skipped).alias("parsed"), F.count_if(skipped).alias("skipped")]


def table_freshness(parsed: DataFrame, host: str, as_of: datetime) -> DataFrame:
    """Freshness of each monitored (table, column), as the state table stores it."""
    now = instant(as_of)
    return parsed.select(
        "table_name",
        "column_name",
        F.lit(host).alias("zabbix_host"),
        "zabbix_item_id",
        "zabbix_item_name",
        "last_data_timestamp",
        float_age_hours(now, F.col("last_data_timestamp")).alias("data_age_hours"),
        now.alias("check_time"),
        "last_clock",
    )


def stale_table_count(freshness: DataFrame) -> DataFrame:
    """One row: monitored tables and those past the fixed stale limit."""
    return freshness.agg(
        F.count(F.lit(1)).alias("tables"), F.count_if(is_stale_table(F.col("data_age_hours"))).alias("stale_tables")
    )
