"""Reports over the finding history and the table state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ages import instant, resolve_as_of
from tidemark.functions.labels import STALE, age_label, is_stale_table, timestamp_label
from tidemark.sinks.contract import Contract
from tidemark.sinks.history import PARTITION, newest_runs, runs, type_counts


def latest_check(history: DataFrame) -> DataFrame:
    """The rows of the newest check.

    Of a stored history, ``read_history(newest=True)`` opens the newest run only;
    this then changes nothing.
    """
    newest = history.agg(F.max("check_time").alias("t"))
    return history.where(F.col("check_time") == newest.scalar())


def latest_check_summary(history: DataFrame) -> DataFrame:
    """Findings per type in the newest check."""
    return latest_check(history).groupBy("finding_type").agg(F.count(F.lit(1)).alias("count"))


def latest_stale_list(history: DataFrame, columns: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """STALE findings of the newest check, oldest first."""
    rows = latest_check(history).where(F.col("finding_type") == STALE)
    order = [F.col("data_age_hours").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    return rows.orderBy(*order).select(*columns)


def finding_trend(history: DataFrame, last_days: int | None = None, as_of: datetime | None = None) -> DataFrame:
    """Findings per day and type, newest day first; all days unless ``last_days``.

    Of a stored history, ``read_history(since=day)`` opens the wanted runs only.
    """
    day = F.col(PARTITION) if PARTITION in history.columns else F.to_date("check_time")
    if last_days is not None:
        if as_of is None:
            raise ValueError("a limited trend needs the instant to count back from")
        history = history.where(day > F.date_sub(F.to_date(instant(as_of)), last_days))
    return (
        history.groupBy(day.alias("check_date"), "finding_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("check_date").desc(), "finding_type")
    )


def logged_trend(
    spark: SparkSession, location: str, contract: Contract, last_days: int | None = None, as_of: datetime | None = None
) -> DataFrame:
    """:func:`finding_trend` of a stored history, from the counts in its log: no findings are read."""
    since = None
    if last_days is not None:
        if as_of is None:
            raise ValueError("a limited trend needs the instant to count back from")
        since = resolve_as_of(as_of).astimezone(timezone.utc).date() - timedelta(days=last_days - 1)
    counts = type_counts(spark, location, contract, runs(spark, location, since))
    return (
        counts.groupBy("check_date", "finding_type")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.col("check_date").desc(), "finding_type")
    )


def logged_summary(spark: SparkSession, location: str, contract: Contract) -> DataFrame:
    """:func:`latest_check_summary` of a stored history, from the counts in its log."""
    counts = type_counts(spark, location, contract, newest_runs(spark, location))
    return counts.groupBy("finding_type").agg(F.sum("count").alias("count"))


def table_report(freshness: DataFrame) -> DataFrame:
    """Table freshness as shown to people, oldest first, then by item; an unknown age counts as 0."""
    age = F.col("data_age_hours")
    return (
        freshness.select(
            "table_name",
            "column_name",
            timestamp_label(F.col("last_data_timestamp")).alias("last_data"),
            age_label(age).alias("age"),
            F.when(is_stale_table(age), F.lit(STALE)).otherwise(F.lit("")).alias("marker"),
            F.coalesce(age, F.lit(0)).alias("_age"),
            F.col("zabbix_item_name").alias("_item"),
            F.col("zabbix_item_id").try_cast("bigint").alias("_number"),
            F.col("zabbix_item_id").alias("_id"),
        )
        .orderBy(F.col("_age").desc(), "_item", "_number", "_id")
        .drop("_age", "_item", "_number", "_id")
    )
