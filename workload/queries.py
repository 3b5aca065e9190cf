"""One Spark query per operator and job, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import ages, labels, parsing
from tidemark.operators import filters, items, ordering
from tidemark.operators.findings import (
    NULL_IS_EPOCH,
    NULL_IS_MISSING,
    Feed,
    dual_source_findings,
    missing_records,
    single_source_findings,
    stamped,
)
from tidemark.operators.latest import latest_per_key
from tidemark.plans import checks, jobs, reports
from tidemark.session import scratch_dir
from tidemark.sinks.contract import violations
from tidemark.sinks import history as history_log
from tidemark.sinks.history import read_history
from tidemark.sinks.state import StateTable
from tidemark.sinks.tables import MONITORING_VM, TABLE_MONITORING
from tidemark.sources import pages, responses
from tidemark.sources.lists import list_relation
from tidemark.sources.tables import Lake
from workload import standins
from workload.standins import AS_OF, DUAL_HOURS, SINGLE_HOURS, TENANT, source_lake, standin, standin_lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def as_doubles(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, the common ground of both engines' results."""
    return frame.select(
        [F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in frame.dtypes]
    )


# --- sources ----------------------------------------------------------------


@query
def table_scan(spark, sf_dir):
    return source_lake(spark, sf_dir).table("orders").select("o_orderkey", "o_custkey", "o_orderdate")


@query
def paged_json_inventory(spark, sf_dir):
    landed = pages.read_pages(spark, standins.land_cluster_pages(spark, sf_dir))
    return pages.page_records(pages.whole_chain(landed))


@query
def page_chain_faults(spark, sf_dir):
    """Of pages of which every 11th got lost and every 7th was landed twice."""
    landed = pages.read_pages(spark, standins.land_cluster_pages(spark, sf_dir))
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("int")
    kept = landed.where(number % 11 != 5)
    return pages.chain_faults(kept.unionByName(kept.where(number % 7 == 3)))


@query
def nested_slug_filter(spark, sf_dir):
    return pages.cluster_inventory(spark, standins.land_cluster_pages(spark, sf_dir))


@query
def item_feed(spark, sf_dir):
    landed = responses.read_responses(
        spark, standins.land_item_responses(spark, sf_dir), responses.ITEM_RESPONSE_SCHEMA
    )
    return responses.item_feed(responses.results_or_fail(landed))


@query
def envelope_errors(spark, sf_dir):
    return responses.error_envelopes(standins.item_responses(spark, sf_dir, errors=True))


@query
def items_with_tag(spark, sf_dir):
    tagged = responses.items_with_tag(responses.results_or_fail(standins.item_responses(spark, sf_dir)))
    return tagged.select("itemid", "hostid", F.size("tags").alias("tags"))


@query
def items_of_host(spark, sf_dir):
    hosts = responses.results_or_fail(standins.host_responses(spark, sf_dir))
    found = responses.items_of_host(responses.results_or_fail(standins.item_responses(spark, sf_dir)), hosts)
    return found.select("itemid", "hostid")


@query
def list_relation_counts(spark, sf_dir):
    names = list_relation(spark, ["BUILDING", "HOUSEHOLD", "SHIPYARD", "BUILDING"])
    customers = source_lake(spark, sf_dir).table("customer")
    per_segment = customers.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    return names.join(per_segment, F.col("name") == F.col("segment"), "left").select("name", "customers")


QUERIES["list_relation"] = QUERIES.pop("list_relation_counts")

# --- projections and predicates ---------------------------------------------


@query
def prefixed_projection(spark, sf_dir):
    customers = source_lake(spark, sf_dir).table("customer")
    return filters.renamed(customers, filters.prefixed("inventory_", "c_custkey", "c_name", "c_mktsegment"))


def _orders(spark, sf_dir, condition):
    return source_lake(spark, sf_dir).table("orders").where(condition).select("o_orderkey", "o_orderpriority")


@query
def tag_contains(spark, sf_dir):
    return _orders(spark, sf_dir, filters.tag_contains("o_orderpriority", "I"))


@query
def tag_equals(spark, sf_dir):
    return _orders(spark, sf_dir, F.col("o_orderpriority") == "2-HIGH")


@query
def tag_in_list(spark, sf_dir):
    return _orders(spark, sf_dir, filters.tag_in("o_orderpriority", ["1-URGENT", "5-LOW"]))


@query
def key_not_null(spark, sf_dir):
    machines = standin(spark, sf_dir, "netbox_vm")
    return machines.where(F.col("custom_fields_uuid").isNotNull()).select("id", "custom_fields_uuid")


@query
def key_not_blank(spark, sf_dir):
    machines = standin(spark, sf_dir, "netbox_vm")
    return machines.where(filters.not_blank("custom_fields_moid")).select("id", "custom_fields_moid")


@query
def status_exclusion(spark, sf_dir):
    machines = standin(spark, sf_dir, "netbox_vm")
    return machines.where(filters.status_is_not("status_value", checks.POWERED_OFF)).select("id", "status_value")


# --- latest row, joins, findings --------------------------------------------


def _latest_orders(spark, sf_dir):
    orders = source_lake(spark, sf_dir).table("orders").where(filters.tag_contains("o_orderpriority", "I"))
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query
def latest_per_key_orders(spark, sf_dir):
    return _latest_orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


QUERIES["latest_per_key"] = QUERIES.pop("latest_per_key_orders")


def _single_inventory(spark, sf_dir):
    """Latest order per customer that is tagged and not closed."""
    orders = source_lake(spark, sf_dir).table("orders").where(
        filters.tag_contains("o_orderpriority", "I")
        & F.col("o_custkey").isNotNull()
        & filters.status_is_not("o_orderstatus", "F")
    )
    latest = latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return latest.select(F.col("o_custkey").alias("inv_id"), F.col("o_orderkey").alias("inv_ref"))


def _event_feed(spark, sf_dir):
    """Every event is an observation: keys repeat, so findings fan out."""
    events = source_lake(spark, sf_dir).table("events")
    frame = events.select(F.col("user_id").alias("obs_key"), "event_id", F.col("ts").alias("last_observed"))
    return Feed("EVENTS", frame, "obs_key", "last_observed", "inv_id")


def single_findings(spark, sf_dir):
    return single_source_findings(_single_inventory(spark, sf_dir), _event_feed(spark, sf_dir), AS_OF, SINGLE_HOURS)


@query
def findings_single(spark, sf_dir):
    return as_doubles(single_findings(spark, sf_dir))


@query
def missing_only_anti(spark, sf_dir):
    return missing_records(_single_inventory(spark, sf_dir), _event_feed(spark, sf_dir))


def _dual_feeds(spark, sf_dir):
    events = source_lake(spark, sf_dir).table("events")
    seen = F.when(F.col("user_id") % 10 != 3, F.col("ts"))
    clicks = events.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("a_key"), seen.alias("a_ts"), F.col("event_id").alias("a_id")
    )
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    # Every third user is in no inventory.
    unlisted = F.concat(F.lit("unlisted-"), F.col("user_id").cast("string"))
    listed = F.when(F.col("user_id") % 3 == 0, unlisted).otherwise(name)
    purchases = events.where(F.col("event_type") == "purchase").select(
        listed.alias("b_key"), F.col("ts").alias("b_ts"), F.col("event_id").alias("b_id")
    )
    return (
        Feed("A", clicks, "a_key", "a_ts", "inv_id", ("a_id",)),
        Feed("B", purchases, "b_key", "b_ts", "inv_name", ("b_id",)),
    )


def _dual_findings(spark, sf_dir, null_policy):
    customers = source_lake(spark, sf_dir).table("customer")
    inventory = customers.select(F.col("c_custkey").alias("inv_id"), F.col("c_name").alias("inv_name"))
    first, second = _dual_feeds(spark, sf_dir)
    return as_doubles(
        dual_source_findings(inventory, first, second, AS_OF, DUAL_HOURS, null_policy, F.xxhash64("inv_id"))
    )


@query
def findings_dual_epoch(spark, sf_dir):
    return _dual_findings(spark, sf_dir, NULL_IS_EPOCH)


@query
def findings_dual_nullsafe(spark, sf_dir):
    return _dual_findings(spark, sf_dir, NULL_IS_MISSING)


@query
def stamped_findings(spark, sf_dir):
    return as_doubles(stamped(single_findings(spark, sf_dir), AS_OF, SINGLE_HOURS))


# --- scalar expressions -----------------------------------------------------


def _event_times(spark, sf_dir):
    return source_lake(spark, sf_dir).table("events").select("event_id", "user_id", "ts")


@query
def threshold_instant(spark, sf_dir):
    limit = ages.threshold_instant(ages.instant(AS_OF), SINGLE_HOURS)
    return _event_times(spark, sf_dir).select(
        "event_id", limit.alias("limit_at"), (F.col("ts") < limit).alias("is_stale")
    )


@query
def age_hours(spark, sf_dir):
    now = ages.instant(AS_OF)
    return as_doubles(
        _event_times(spark, sf_dir).select(
            "event_id",
            ages.age_hours(now, F.col("ts")).alias("age_hours"),
            ages.float_age_hours(now, F.col("ts")).alias("float_age_hours"),
        )
    )


@query
def age_days_label(spark, sf_dir):
    age = ages.age_hours(ages.instant(AS_OF), F.col("ts"))
    unknown = F.when(F.col("user_id") % 10 != 3, age)
    return _event_times(spark, sf_dir).select(
        "event_id",
        ages.age_days_label(unknown).alias("age_days"),
        ages.whole_days((F.col("user_id") + 1)).alias("threshold_days"),
    )


def _event_pairs(spark, sf_dir):
    """A first and a second instant per event; either may be unknown, some tie."""
    events = _event_times(spark, sf_dir)
    first = F.when(F.col("event_id") % 5 != 0, F.col("ts"))
    second = F.when(F.col("event_id") % 7 == 0, F.col("ts")).when(
        F.col("event_id") % 3 != 0, F.col("ts") + F.make_dt_interval(F.lit(0), (F.col("user_id") % 5 - 2).cast("int"))
    )
    return events.select("event_id", first.alias("first_ts"), second.alias("second_ts"))


@query
def most_recent_observed(spark, sf_dir):
    latest = labels.most_recent_observed(F.col("first_ts"), F.col("second_ts"))
    return _event_pairs(spark, sf_dir).select("event_id", latest.alias("most_recent_observed"))


@query
def most_recent_source(spark, sf_dir):
    source = labels.most_recent_source(F.col("first_ts"), "FIRST", F.col("second_ts"), "SECOND")
    return _event_pairs(spark, sf_dir).select("event_id", source.alias("most_recent_source"))


@query
def parsed_timestamps(spark, sf_dir):
    values = standin(spark, sf_dir, "item").select("itemid", parsing.strip_blanks(F.col("lastvalue")).alias("value"))
    return parsing.with_instants(values, "value", "last_data_timestamp").select("itemid", "last_data_timestamp")


@query
def parsed_items(spark, sf_dir):
    return items.parsed_items(standin(spark, sf_dir, "item"))


# --- counts, order, previews ------------------------------------------------


@query
def finding_counts(spark, sf_dir):
    return ordering.finding_counts(single_findings(spark, sf_dir))


@query
def ordered_findings(spark, sf_dir):
    ordered = ordering.ordered_findings(single_findings(spark, sf_dir), ["inv_id", "event_id"])
    return as_doubles(ordering.ranked(ordered))


@query
def preview_top20(spark, sf_dir):
    columns = {"inv_id": "record", "inv_ref": "reference", "obs_key": "observed_key"}
    return ordering.preview(single_findings(spark, sf_dir), columns, ["inv_id", "event_id"])


@query
def preview_remaining(spark, sf_dir):
    return ordering.preview_remaining(single_findings(spark, sf_dir))


@query
def item_parse_counts(spark, sf_dir):
    return items.item_parse_counts(standin(spark, sf_dir, "item"))


def _table_freshness(spark, sf_dir):
    return jobs.detect_tables(standins.item_responses(spark, sf_dir), standins.host_responses(spark, sf_dir), AS_OF)


@query
def stale_table_count(spark, sf_dir):
    return items.stale_table_count(_table_freshness(spark, sf_dir))


@query
def table_report(spark, sf_dir):
    return ordering.ranked(reports.table_report(_table_freshness(spark, sf_dir)))


# --- sinks ------------------------------------------------------------------


def _vm_lake(spark, sf_dir):
    return standin_lake(spark, sf_dir, "netbox_vm", "nutanix_vm")


@query
def append_findings(spark, sf_dir):
    history = scratch_dir(spark, "history")
    jobs.run_check(checks.NUTANIX_VM, _vm_lake(spark, sf_dir), history, AS_OF, SINGLE_HOURS)
    return as_doubles(read_history(spark, history, MONITORING_VM))


def _vmware_lake(spark, sf_dir):
    return standin_lake(spark, sf_dir, "netbox_vm", "vmware_vm")


def _vm_runs(spark, sf_dir, *moments):
    history = scratch_dir(spark, "history")
    for moment in moments:
        jobs.run_check(checks.NUTANIX_VM, _vm_lake(spark, sf_dir), history, moment, SINGLE_HOURS)
    return history


_HISTORIES: dict[tuple[str, str], str] = {}


def _vm_history(spark, sf_dir):
    """Three runs of the machine check, a day apart, the newest last.

    A history is there before reports are asked for, so it is written once a session.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HISTORIES or not history_log.runs(spark, _HISTORIES[key]):
        _HISTORIES[key] = _vm_runs(spark, sf_dir, *[AS_OF - timedelta(days=days) for days in (2, 1, 0)])
    return _HISTORIES[key]


@query
def newest_run(spark, sf_dir):
    """The newest run of a history of several, opened by the log."""
    newest = read_history(spark, _vm_history(spark, sf_dir), MONITORING_VM, newest=True)
    return as_doubles(reports.latest_check(newest))


@query
def run_summary(spark, sf_dir):
    return history_log.run_summary(spark, _vm_history(spark, sf_dir))


@query
def folded_history(spark, sf_dir):
    """Three runs of one day folded into one folder, and a fourth that came later."""
    hours = [timedelta(hours=h) for h in (9, 6, 3, 0)]
    moment = AS_OF + timedelta(hours=12)
    history = _vm_runs(spark, sf_dir, *[moment - h for h in hours[:3]])
    history_log.fold_day(spark, history, MONITORING_VM, moment.date())
    jobs.run_check(checks.NUTANIX_VM, _vm_lake(spark, sf_dir), history, moment, SINGLE_HOURS)
    return as_doubles(read_history(spark, history, MONITORING_VM))


@query
def dry_run_findings(spark, sf_dir):
    run = jobs.run_check(
        checks.NUTANIX_VM, _vm_lake(spark, sf_dir), as_of=AS_OF, threshold_hours=SINGLE_HOURS, dry_run=True
    )
    return as_doubles(run.findings)


@query
def upsert_state(spark, sf_dir):
    """All items in two batches: even ones first, then odd ones over them."""
    state = StateTable(spark, scratch_dir(spark, "state"), TABLE_MONITORING).create()
    for remainder in (0, 1):
        batch = standin(spark, sf_dir, "item").where(F.col("event_id") % 2 == remainder)
        freshness = items.table_freshness(items.parsed_items(batch), responses.DEFAULT_HOST, AS_OF)
        state.upsert(freshness, newest="last_clock", tiebreak=jobs.item_order())
    return as_doubles(state.current())


@query
def contract_violations(spark, sf_dir):
    key = F.col("o_orderkey")
    findings = source_lake(spark, sf_dir).table("orders").select(
        F.when(key % 11 != 0, ages.instant(AS_OF)).alias("check_time"),
        F.when(key % 101 != 0, F.lit("vm")).alias("netbox_vm_name"),
        F.when(key % 103 == 0, F.repeat(F.lit("x"), 256)).otherwise(F.repeat(F.lit("x"), 255)).alias("nutanix_component_moid"),
        F.when(key % 107 == 0, F.lit(99999999.996)).otherwise(F.lit(99999999.99)).cast("decimal(18,3)").alias("data_age_hours"),
        F.when(key % 109 == 0, F.lit(None)).when(key % 113 == 0, F.lit("AN OVERLONG FINDING LABEL")).otherwise(F.lit("STALE")).alias("finding_type"),
    )
    return violations(findings, MONITORING_VM)


# --- jobs and reports -------------------------------------------------------


def _job(spark, lake: Lake, check, hours):
    return as_doubles(jobs.detect(check, lake, AS_OF, hours))


def _written(spark, lake: Lake, check, hours):
    """A job as run in production: suspects staged, findings appended and read back."""
    history = scratch_dir(spark, "history")
    jobs.run_check(check, lake, history, AS_OF, hours)
    return as_doubles(read_history(spark, history, check.contract))


def _previewed(spark, lake: Lake, check, hours):
    return ordering.preview(jobs.detect(check, lake, AS_OF, hours), check.preview, [check.row_id])


@query
def job_vm_uuid(spark, sf_dir):
    return _job(spark, _vm_lake(spark, sf_dir), checks.NUTANIX_VM, SINGLE_HOURS)


@query
def job_vm_moid(spark, sf_dir):
    return _job(spark, _vmware_lake(spark, sf_dir), checks.VMWARE_VM, SINGLE_HOURS)


@query
def job_vm_moid_written(spark, sf_dir):
    return _written(spark, _vmware_lake(spark, sf_dir), checks.VMWARE_VM, SINGLE_HOURS)


@query
def preview_vm_uuid(spark, sf_dir):
    return _previewed(spark, _vm_lake(spark, sf_dir), checks.NUTANIX_VM, SINGLE_HOURS)


@query
def preview_vm_moid(spark, sf_dir):
    return _previewed(spark, _vmware_lake(spark, sf_dir), checks.VMWARE_VM, SINGLE_HOURS)


def _host_lake(spark, sf_dir):
    return standin_lake(spark, sf_dir, "netbox_device", "nutanix_host", "vmware_host")


@query
def job_host_serial_first(spark, sf_dir):
    return _job(spark, _host_lake(spark, sf_dir), checks.nutanix_host(TENANT), DUAL_HOURS)


@query
def job_host_name_first(spark, sf_dir):
    return _job(spark, _host_lake(spark, sf_dir), checks.vmware_host(TENANT), DUAL_HOURS)


@query
def job_host_staged(spark, sf_dir):
    return _written(spark, _host_lake(spark, sf_dir), checks.nutanix_host(TENANT), DUAL_HOURS)


@query
def job_host_name_first_written(spark, sf_dir):
    return _written(spark, _host_lake(spark, sf_dir), checks.vmware_host(TENANT), DUAL_HOURS)


@query
def preview_host_serial_first(spark, sf_dir):
    return _previewed(spark, _host_lake(spark, sf_dir), checks.nutanix_host(TENANT), DUAL_HOURS)


@query
def preview_host_name_first(spark, sf_dir):
    return _previewed(spark, _host_lake(spark, sf_dir), checks.vmware_host(TENANT), DUAL_HOURS)


def _cluster_lake(spark, sf_dir):
    clusters = pages.cluster_inventory(spark, standins.land_cluster_pages(spark, sf_dir))
    return Lake(
        spark,
        {
            "netbox_cluster": clusters,
            "nutanix_cluster": standin(spark, sf_dir, "nutanix_cluster"),
            "vmware_cluster": standin(spark, sf_dir, "vmware_cluster"),
        },
    )


@query
def job_cluster(spark, sf_dir):
    return _job(spark, _cluster_lake(spark, sf_dir), checks.CLUSTER, DUAL_HOURS)


@query
def job_cluster_written(spark, sf_dir):
    return _written(spark, _cluster_lake(spark, sf_dir), checks.CLUSTER, DUAL_HOURS)


@query
def preview_cluster(spark, sf_dir):
    return _previewed(spark, _cluster_lake(spark, sf_dir), checks.CLUSTER, DUAL_HOURS)


@query
def job_table_freshness(spark, sf_dir):
    state = StateTable(spark, scratch_dir(spark, "state"), TABLE_MONITORING).create()
    jobs.run_tables(standins.item_responses(spark, sf_dir), standins.host_responses(spark, sf_dir), state, AS_OF)
    return as_doubles(state.current())


@query
def table_run_counts(spark, sf_dir):
    """What a run of the table check reports besides its rows."""
    state = StateTable(spark, scratch_dir(spark, "state"), TABLE_MONITORING).create()
    run = jobs.run_tables(standins.item_responses(spark, sf_dir), standins.host_responses(spark, sf_dir), state, AS_OF)
    kinds = "written bigint, parsed bigint, skipped bigint, stale bigint"
    return spark.createDataFrame([(run.written, run.parsed, run.skipped, run.stale)], kinds)


@query
def latest_check_summary(spark, sf_dir):
    return reports.latest_check_summary(standin(spark, sf_dir, "history"))


@query
def latest_stale_list(spark, sf_dir):
    columns = ["netbox_vm_name", "nutanix_last_observed", "data_age_hours", "netbox_cluster_name"]
    return ordering.ranked(reports.latest_stale_list(standin(spark, sf_dir, "history"), columns, ["event_id"]))


@query
def finding_trend(spark, sf_dir):
    """From the log of a stored history; a row for each day and type, so one task can number them."""
    trend = reports.logged_trend(spark, _vm_history(spark, sf_dir), MONITORING_VM)
    place = F.row_number().over(Window.orderBy(F.col("check_date").desc(), "finding_type"))
    return trend.withColumn("position", place)


@query
def finding_trend_rows(spark, sf_dir):
    return ordering.ranked(reports.finding_trend(standin(spark, sf_dir, "history")))


@query
def logged_summary(spark, sf_dir):
    return reports.logged_summary(spark, _vm_history(spark, sf_dir), MONITORING_VM)
