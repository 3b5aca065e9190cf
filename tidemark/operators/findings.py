"""Inventory against what was observed: MISSING and STALE findings.

Frames come in already projected to their output columns, so inventory and
feeds have no column name in common.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ages import age_hours, epoch, float_age_hours, instant, threshold_instant
from tidemark.functions.labels import MISSING, STALE, finding_label, most_recent_observed, most_recent_source
from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import (
    HEAVY_MIN_ROWS,
    HEAVY_SHARE,
    NO_HEAVY_KEYS,
    HeavyKeys,
    heavy_from,
    key_sketches,
    lookup,
    repeatable_spread,
)
from tidemark.session import staged

# What a matched row without a last-observed time means.
NULL_IS_EPOCH = "epoch"  # as old as 1970: stale
NULL_IS_MISSING = "missing"  # as good as no row

# Suspect keys up to this size are broadcast; beyond it old rows are not
# reduced before their latest row is taken.
BROADCAST_BYTES = 128 * 1024 * 1024
BYTES_PER_KEY = 32


@dataclass(frozen=True)
class Feed:
    """An observed source: its rows, their key and time columns, the inventory
    column the key is compared with, and columns that settle equal times."""

    label: str
    frame: DataFrame
    key: str
    observed_at: str
    matches: str
    tiebreak: tuple[str, ...] = ()


def single_source_findings(
    inventory: DataFrame,
    feed: Feed,
    as_of: datetime,
    threshold_hours: int,
    heavy_rows: int = HEAVY_MIN_ROWS,
    share: int = HEAVY_SHARE,
) -> DataFrame:
    """Findings against one source; ``inventory`` has unique ``feed.matches``.

    The source is not deduplicated: a record gives one STALE row per stale
    source row.  A matched row with no time is neither, hence no finding.

    A left join followed by "no match or stale" would shuffle the whole source
    at full width.  One narrow pass counts the stale rows of every key instead, per
    task first.  A record without a count is MISSING, one with none stale is healthy
    and goes; only for the rest are the stale rows read at full width (the time
    filter reaches the scan).

    The same counts tell the heavy keys, those with at least ``heavy_rows`` stale
    rows and one in ``share`` of all, so there are at most ``share`` of them.  They
    are broadcast to the stale rows, which are then dealt over as many parts as the
    key has multiples of ``heavy_rows``, and the record is copied to each.
    """
    now = instant(as_of)
    limit = threshold_instant(now, threshold_hours)
    key, seen_at = F.col(feed.key), F.col(feed.observed_at)

    keyed = feed.frame.where(key.isNotNull())
    # Used three times; Spark reads the source for it once and reuses the exchange.
    counts = keyed.groupBy(key.alias("_seen")).agg(F.count_if(seen_at < limit).alias("_old"))
    total = counts.agg(F.coalesce(F.sum("_old"), F.lit(0)).alias("t")).scalar()
    many = F.greatest(F.lit(heavy_rows), F.ceil(total / share))
    heavy = counts.where(F.col("_old") >= many).select(F.col("_seen").alias("_heavy"), F.col("_old").alias("_of"))
    parts = F.ceil(F.col("_of") / heavy_rows)

    known = inventory.join(counts, F.col(feed.matches) == F.col("_seen"), "left")
    copies = F.when(F.col("_old") >= many, F.ceil(F.col("_old") / heavy_rows)).otherwise(1)
    suspects = known.where(F.col("_seen").isNull() | (F.col("_old") > 0)).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))
    )
    old = keyed.where(seen_at < limit)
    dealt = old.withColumn("_spread", repeatable_spread(old)).join(F.broadcast(heavy), key == F.col("_heavy"), "left")
    rows = dealt.select(*feed.frame.columns, F.coalesce(F.pmod("_spread", parts), F.lit(0)).alias("_dealt"))
    met = (F.col(feed.matches) == key) & (F.col("_part") == F.col("_dealt"))
    found = suspects.join(rows, met, "left")
    missing = F.col("_seen").isNull()
    return found.where(missing | key.isNotNull()).select(
        *inventory.columns,
        *feed.frame.columns,
        age_hours(now, seen_at).alias("data_age_hours"),
        F.when(missing, F.lit(MISSING)).otherwise(F.lit(STALE)).alias("finding_type"),
    )


def missing_records(inventory: DataFrame, feed: Feed) -> DataFrame:
    """Inventory records whose key the source has never seen."""
    seen = feed.frame.select(feed.key).distinct()
    return inventory.join(seen, F.col(feed.matches) == F.col(feed.key), "left_anti")


def dual_source_findings(
    inventory: DataFrame,
    first: Feed,
    second: Feed,
    as_of: datetime,
    threshold_hours: int,
    null_policy: str,
    spread: Column,
    heavy: dict[str, HeavyKeys] | None = None,
    stage: bool = False,
) -> DataFrame:
    """Findings against the latest rows of two sources.

    Adds ``most_recent_source`` (a tie goes to ``first``), ``most_recent_observed``,
    ``data_age_hours`` and ``finding_type``.  The sources may be keyed on
    different inventory columns, and those may repeat, be blank or be NULL in
    the inventory: heavy values are salted, those in ``heavy`` or, with ``stage``, as
    found on the way.  ``spread`` tells inventory rows apart, see
    :func:`~tidemark.operators.lookup.lookup`.

    ``null_policy`` settles a matched row without a time: with ``epoch`` it was
    seen in 1970, and so was a record no source knows; with ``missing`` it does
    not count.

    A record either source has a fresh row for is healthy whatever the other
    columns say.  Such records are dropped first, against just the keys of the
    fresh rows; the full width of a source is only read and shuffled for its
    old rows.  A key that is left has no fresh row, so its latest old row is its
    latest row.

    With ``stage`` the inventory and then the suspects left are written out (two
    actions), so each is worked out once, and frequency sketches of their keys come
    with the writes instead of from a pass of their own.  If the suspects' keys are
    few, the old rows of all other keys are dropped at the scan, which is what a
    source with a long history needs.
    """
    if null_policy not in (NULL_IS_EPOCH, NULL_IS_MISSING):
        raise ValueError(f"unknown null policy {null_policy!r}")
    matches = sorted({first.matches, second.matches})
    heavy = heavy or {}
    if stage:
        inventory, seen = staged(inventory, "inventory", key_sketches(matches))
        heavy = heavy_from(seen, matches)
    now = instant(as_of)
    limit = threshold_instant(now, threshold_hours)

    def match(records: DataFrame, feed: Feed, rows: DataFrame, how: str) -> DataFrame:
        keys = heavy.get(feed.matches, NO_HEAVY_KEYS)
        return lookup(records, rows, feed.matches, feed.key, how, keys, F.col("_spread"))

    suspects = inventory.withColumn("_spread", spread)
    for feed in (first, second):
        fresh = feed.frame.where(F.col(feed.observed_at) >= limit).select(feed.key).distinct()
        suspects = match(suspects, feed, fresh, "left_anti")
    key_bytes = {}
    if stage:
        sizes = {f"_bytes_{k}": _total_bytes(k) for k in matches}
        suspects, seen = staged(suspects, "suspects", sizes | key_sketches(matches))
        key_bytes = {k: seen[f"_bytes_{k}"] or 0 for k in matches}
        heavy = heavy_from(seen, matches)
    # Last anti-joined, first looked up: unless staged, the records are still
    # partitioned on the second source's key.
    for feed in (second, first):
        seen = F.col(feed.observed_at)
        old = feed.frame.where((seen < limit) | seen.isNull())
        if key_bytes.get(feed.matches, BROADCAST_BYTES) < BROADCAST_BYTES:
            wanted = suspects.select(F.col(feed.matches).alias("_wanted")).distinct()
            old = old.join(F.broadcast(wanted), F.col(feed.key) == F.col("_wanted"), "left_semi")
        latest = latest_per_key(old, [feed.key], feed.observed_at, feed.tiebreak)
        suspects = match(suspects, feed, latest, "left")

    a, b = F.col(first.observed_at), F.col(second.observed_at)
    observed = most_recent_observed(a, b)
    if null_policy == NULL_IS_EPOCH:
        last = most_recent_observed(F.coalesce(a, epoch()), F.coalesce(b, epoch()))
        missing = F.col(first.key).isNull() & F.col(second.key).isNull()
        age = age_hours(now, last)
    else:
        last = observed
        missing = observed.isNull()
        age = float_age_hours(now, last)

    # Suspects are findings, but for a limit before 1970.
    return suspects.where(missing | (last < limit)).select(
        *inventory.columns,
        *first.frame.columns,
        *second.frame.columns,
        most_recent_source(a, first.label, b, second.label).alias("most_recent_source"),
        observed.alias("most_recent_observed"),
        age.alias("data_age_hours"),
        finding_label(missing, last < limit).alias("finding_type"),
    )


def _total_bytes(key: str) -> Column:
    """About what a key column takes in memory, repeats included."""
    return F.sum(F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + F.lit(BYTES_PER_KEY))


def stamped(findings: DataFrame, as_of: datetime, threshold_hours: int) -> DataFrame:
    """Findings with the run's time and threshold in front."""
    return findings.select(
        instant(as_of).alias("check_time"), F.lit(threshold_hours).cast("int").alias("check_threshold_hours"), "*"
    )
