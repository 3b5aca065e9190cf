"""Finding order, previews and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ages import age_days_label
from tidemark.functions.labels import MISSING, STALE, or_dash
from tidemark.session import staged

PREVIEW_ROWS = 20


def finding_order(tiebreak: Sequence[str] = ()) -> list[Column]:
    """MISSING first, then oldest first with unknown ages on top."""
    return [
        F.when(F.col("finding_type") == MISSING, 0).otherwise(1).asc(),
        F.col("data_age_hours").desc_nulls_first(),
        *[F.col(c).asc_nulls_last() for c in tiebreak],
    ]


def ordered_findings(findings: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    return findings.orderBy(*finding_order(tiebreak))


def ranked(ordered: DataFrame, name: str = "position") -> DataFrame:
    """A sorted frame with each row's place in it, counted from 1.

    The sorted rows are written to the shared folder (an action) with their place
    within their partition; adding the sizes of the partitions before gives the
    rank, without a window over all rows in one task.
    """
    numbered = ordered.withColumn("_place", F.monotonically_increasing_id())
    rows, _ = staged(numbered, "ranked", {})
    # The place holds the partition in its upper bits and counts from 0 in the lower 33.
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row for each partition of the sort
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), "_part").select(
        *ordered.columns, (F.col("_before") + place + 1).cast("bigint").alias(name)
    )


def finding_counts(findings: DataFrame) -> DataFrame:
    """One row: ``total``, ``stale`` and ``missing``."""
    return findings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("finding_type") == STALE).alias("stale"),
        F.count_if(F.col("finding_type") == MISSING).alias("missing"),
    )


def preview(
    findings: DataFrame, columns: Mapping[str, str], tiebreak: Sequence[str], rows: int = PREVIEW_ROWS
) -> DataFrame:
    """The first ``rows`` findings of each type in finding order.

    ``columns`` maps finding columns to display names; NULLs show as ``-``.  Adds
    the ``position`` within the type and the ``age_days`` label.  Every task cuts
    to ``rows`` per type before the shuffle, so the two groups stay small.
    """
    order = [F.col("data_age_hours").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    position = F.row_number().over(Window.partitionBy("finding_type").orderBy(*order))
    return (
        findings.withColumn("position", position)
        .where(F.col("position") <= rows)
        .select(
            "finding_type",
            "position",
            *[or_dash(F.col(c)).alias(name) for c, name in columns.items()],
            age_days_label(F.col("data_age_hours")).alias("age_days"),
        )
    )


def preview_remaining(findings: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """Per type, how many findings there are and how many a preview leaves out."""
    counts = findings.groupBy("finding_type").agg(F.count(F.lit(1)).alias("total"))
    return counts.withColumn("remaining", F.greatest(F.col("total") - rows, F.lit(0).cast("bigint")))
