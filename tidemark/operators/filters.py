"""Inventory predicates and the renaming projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_contains(column: str, text: str) -> Column:
    """Case-sensitive substring match."""
    return F.col(column).contains(text)


def tag_in(column: str, accepted: Sequence[str]) -> Column:
    return F.col(column).isin(list(accepted))


def not_blank(column: str) -> Column:
    """Present and not the empty string."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def status_is_not(column: str, excluded: str) -> Column:
    """Any known status but ``excluded``; an unknown (NULL) status is dropped too."""
    return F.col(column) != excluded


def renamed(frame: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project ``columns`` (source name -> output name) in that order."""
    return frame.select([F.col(source).alias(output) for source, output in columns.items()])


def prefixed(prefix: str, *columns: str) -> dict[str, str]:
    """Columns and their output names with a common prefix, for :func:`renamed`."""
    return {c: f"{prefix}{c}" for c in columns}
