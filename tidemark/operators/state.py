"""A batch put over the current state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merged(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``state`` with the rows of ``batch`` put over it; ``batch`` has unique keys.

    Only the batch's keys meet the state in the join, so a small batch is
    broadcast by Spark's own size check and the state is not shuffled.
    """
    kept = state.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*state.columns).unionByName(batch.select(*state.columns))
