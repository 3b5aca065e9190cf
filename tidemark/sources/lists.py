"""Inline lists as relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_relation(spark: SparkSession, names: Sequence[str], column: str = "name") -> DataFrame:
    """One row per list element, repeats kept.  For lists a caller typed in;
    an inventory of any size should be a DataFrame from the start."""
    values = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return spark.range(1).select(F.explode(values).alias(column))
