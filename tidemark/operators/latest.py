"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    frame: DataFrame, keys: Sequence[str], newest: str, tiebreak: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the one with the greatest ``newest`` (unknown last).

    NULL keys form one group.  Equal times are settled by ``tiebreak``,
    smallest first, so the choice is repeatable when those columns identify a row.

    ``row_number() = 1`` lets Spark cut every map task's output to one row per
    key before the shuffle (WindowGroupLimit), so a key that owns a large share
    of the table costs one row per task.
    """
    order = [F.col(newest).desc_nulls_last(), *[(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in tiebreak]]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")
