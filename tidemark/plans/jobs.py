"""Running the checks: detect, stamp, and (unless dry) write."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.ages import resolve_as_of
from tidemark.functions.labels import is_stale_table
from tidemark.operators.findings import dual_source_findings, single_source_findings, stamped
from tidemark.operators.items import parsed_items, table_freshness
from tidemark.operators.lookup import repeatable_spread
from tidemark.plans.checks import Check
from tidemark.sinks.history import append_run
from tidemark.sinks.state import StateTable
from tidemark.sinks.tables import DEFAULT_THRESHOLD_HOURS
from tidemark.sources.responses import DEFAULT_HOST, ITEM_TAG, item_feed, items_of_host, items_with_tag, results_or_fail
from tidemark.sources.tables import Lake


@dataclass(frozen=True)
class Run:
    """A run's findings and how many rows it wrote, STALE and MISSING ones apart; None when dry.

    A run of the table check counts items ``parsed`` and ``skipped`` instead of
    missing rows, and as ``stale`` those past the fixed limit.

    The findings are a plan: asking them for rows detects again.  Building it has
    already looked for heavy keys, and staged if asked to.
    """

    as_of: datetime
    findings: DataFrame
    written: int | None
    stale: int | None = None
    missing: int | None = None
    parsed: int | None = None
    skipped: int | None = None


def item_order() -> list[str | Column]:
    """Of items with one table, column and clock the first by name counts, then the lower id; ids are numbers in text."""
    return ["zabbix_item_name", F.col("zabbix_item_id").try_cast("bigint"), "zabbix_item_id"]


def detect(
    check: Check, lake: Lake, as_of: datetime, threshold_hours: int = DEFAULT_THRESHOLD_HOURS, stage: bool = False
) -> DataFrame:
    """The findings of a check at one instant, stamped; no result is written.

    ``stage`` is for two-source checks over long histories, see
    :func:`~tidemark.operators.findings.dual_source_findings`.
    """
    inventory = check.inventory.frame(lake)
    feeds = [source.feed(lake) for source in check.sources]
    if len(feeds) == 1:
        findings = single_source_findings(inventory, feeds[0], as_of, threshold_hours)
    else:
        if check.inventory.key:
            # Unique after deduplication, so its hash spreads rows and repeats on a re-run.
            spread = F.xxhash64(check.inventory.columns[check.inventory.key])
        else:
            spread = repeatable_spread(inventory)
        findings = dual_source_findings(
            inventory, feeds[0], feeds[1], as_of, threshold_hours, check.null_policy, spread, stage=stage
        )
    return stamped(findings, as_of, threshold_hours)


def run_check(
    check: Check,
    lake: Lake,
    history: str | None = None,
    as_of: datetime | None = None,
    threshold_hours: int = DEFAULT_THRESHOLD_HOURS,
    dry_run: bool = False,
    stage: bool | None = None,
) -> Run:
    """Detect and append to ``history``.  Sources that may change while the run reads
    them are landed once first, so that every record gets one label.  An empty inventory or a healthy fleet
    leaves a run of zeros in the log, no data, and is a success.  A dry run writes nothing at all, so unless
    asked to it does not ``stage`` either."""
    if not dry_run and history is None:
        raise ValueError("a run that is not dry needs a history location")
    moment = resolve_as_of(as_of)
    read_from = lake if dry_run else lake.pin()
    findings = detect(check, read_from, moment, threshold_hours, not dry_run if stage is None else stage)
    if dry_run:
        return Run(moment, findings, None)
    entry = append_run(findings, history, check.contract, moment)
    return Run(moment, findings, entry.total, entry.stale, entry.missing)


def detect_tables(
    item_responses: DataFrame,
    host_responses: DataFrame,
    as_of: datetime,
    host: str = DEFAULT_HOST,
    tag: str = ITEM_TAG,
    counts: Observation | None = None,
) -> DataFrame:
    """Freshness of every table the host's tagged items report on.

    An error response or an unknown host fails the query.
    """
    items = items_of_host(results_or_fail(item_responses), results_or_fail(host_responses), host)
    return table_freshness(parsed_items(item_feed(items_with_tag(items, tag)), counts), host, as_of)


def run_tables(
    item_responses: DataFrame,
    host_responses: DataFrame,
    state: StateTable | None = None,
    as_of: datetime | None = None,
    host: str = DEFAULT_HOST,
    tag: str = ITEM_TAG,
    dry_run: bool = False,
) -> Run:
    """Upsert table freshness into ``state``.  Every table is kept, stale or not."""
    if not dry_run and state is None:
        raise ValueError("a run that is not dry needs a state table")
    moment = resolve_as_of(as_of)
    if dry_run:
        return Run(moment, detect_tables(item_responses, host_responses, moment, host, tag), None)
    counts, stale = Observation("items"), Observation("tables")
    freshness = detect_tables(item_responses, host_responses, moment, host, tag, counts)
    late = F.count_if(is_stale_table(F.col("data_age_hours"))).alias("stale")
    # All counts come with the one write.
    written = state.upsert(freshness.observe(stale, late), newest="last_clock", tiebreak=item_order())
    found = counts.get
    return Run(moment, freshness, written, stale=stale.get["stale"], parsed=found["parsed"], skipped=found["skipped"])
