"""Landed monitoring responses: items and hosts in a result-or-error envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The monitored host and the tag of the items it carries.
DEFAULT_HOST = "db-master"
ITEM_TAG = "last data"

ERROR_TYPE = T.StructType(
    [
        T.StructField("code", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)


def _envelope(result: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("result", T.ArrayType(result)), T.StructField("error", ERROR_TYPE)])


ITEM_RESPONSE_SCHEMA = _envelope(
    T.StructType(
        [
            T.StructField("itemid", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("lastvalue", T.StringType()),
            T.StructField("lastclock", T.StringType()),
            T.StructField("hostid", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StructType([T.StructField("tag", T.StringType())]))),
        ]
    )
)
HOST_RESPONSE_SCHEMA = _envelope(
    T.StructType([T.StructField("hostid", T.StringType()), T.StructField("host", T.StringType())])
)


def read_responses(spark: SparkSession, location: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Responses as landed, one JSON object per line, or per file with ``multiline``."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multiline)
    return reader.json(location)


def error_envelopes(responses: DataFrame) -> DataFrame:
    """The responses that report an error: ``code, message, data``."""
    return responses.where(F.col("error").isNotNull()).select("error.*")


def results_or_fail(responses: DataFrame) -> DataFrame:
    """The result rows of all responses; any error envelope fails the query.

    The check sits on the exploded array itself, so column pruning cannot drop
    it and a failing run writes nothing.
    """
    message = F.concat(
        F.lit("monitoring API error ["),
        F.coalesce(F.col("error.code").cast("string"), F.lit("?")),
        F.lit("]: "),
        F.coalesce(F.col("error.message"), F.lit("")),
        F.lit(" - "),
        F.coalesce(F.col("error.data"), F.lit("")),
    )
    checked = F.when(F.col("error").isNotNull(), F.raise_error(message)).otherwise(F.col("result"))
    return responses.select(F.explode(checked).alias("r")).select("r.*")


def items_with_tag(items: DataFrame, tag: str = ITEM_TAG) -> DataFrame:
    return items.where(F.exists("tags", lambda t: t["tag"] == tag))


def items_of_host(items: DataFrame, hosts: DataFrame, host: str = DEFAULT_HOST) -> DataFrame:
    """Items of the host with that exact name; no such host fails the query."""
    found = hosts.where(F.col("host") == host).agg(F.min("hostid").alias("wanted_hostid"))
    wanted = found.select(
        F.coalesce("wanted_hostid", F.raise_error(F.lit(f"no monitored host named '{host}'"))).alias("wanted_hostid")
    )
    return items.where(F.col("hostid") == wanted.scalar())


def item_feed(items: DataFrame) -> DataFrame:
    """The four fields the table check reads."""
    return items.select("itemid", "name", "lastvalue", "lastclock")
