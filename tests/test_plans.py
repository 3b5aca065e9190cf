"""Properties of the physical plans that matter at scale."""

import os

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from tidemark.operators import findings
from tidemark.operators.findings import Feed, single_source_findings
from tidemark.plans import checks
from tidemark.plans.jobs import detect
from workload.queries import QUERIES
from workload.standins import TENANT, standin_lake

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture
def large(spark):
    """Plans as they are when nothing is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def plan(spark, name):
    return plan_of(QUERIES[name](spark, SF_DIR))


def plan_of(frame):
    frame.collect()
    return "\n".join(final_lines(frame))


def final_lines(frame):
    """Lines of the executed plan, without the plans that subqueries and it began with."""
    kept, skipped_from = [], None
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if skipped_from is not None and at >= skipped_from:
            continue
        skipped_from = at if "== Initial Plan ==" in line else None
        if skipped_from is None:
            kept.append(line)
    return kept


def scans(text, table):
    return [line for line in text.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_joins(large, name):
    text = plan(large, name)
    for operator in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_latest_row_is_cut_before_the_shuffle(large):
    text = plan(large, "latest_per_key")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("Exchange hashpartitioning") == 1


def test_single_source_plan(large):
    text = plan(large, "findings_single")
    # The inventory to its key for the latest row and not again for the first join, the
    # counts, then records and stale rows for the second.
    assert len(scans(text, "orders")) == 1
    assert text.count("+- Exchange hashpartitioning") == 4
    keys, stale = scans(text, "events")
    assert "LessThan(ts" in stale.split("PushedFilters: [")[1]
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint>" in keys


def test_heavy_observed_keys_come_from_the_same_counts(spark, tmp_path):
    """Two scans of the source, also where a key is heavy; and its rows are dealt out."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"),
        F.timestamp_seconds(F.lit(0)).alias("at"),
    )
    rows.repartition(4).write.parquet(str(tmp_path / "rows"))
    feed = Feed("S", spark.read.parquet(str(tmp_path / "rows")), "k", "at", "u")
    inventory = spark.range(-2, 10).select(F.col("id").alias("u"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = single_source_findings(inventory, feed, AS_OF, 24, heavy_rows=500)
        got = found.collect()
        lines = final_lines(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert len([line for line in lines if "FileScan" in line]) == 2
    assert [line for line in lines if "ReusedExchange" in line]
    assert len(got) == 13_334 + 6 + 5  # the heavy key's rows, 1 2 4 5 7 8, and -2 0 3 6 9 missing
    assert sum(r.finding_type == "MISSING" for r in got) == 5


def test_dual_source_plan(large):
    text = plan(large, "findings_dual_epoch")
    # Per source the fresh keys and the old rows; the inventory to the first key,
    # the second (for both its joins), and what is left back to the first.
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("LeftAnti") == 2 and text.count("LeftOuter") == 2
    fresh_b, old_b = [line for line in scans(text, "events") if "purchase" in line]
    # Plans cut long lists of pushed filters short.
    assert "GreaterT" in fresh_b.split("PushedFilters: [")[1]
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,event_type:string>" in fresh_b
    assert "Or(LessThan(ts" in old_b.split("PushedFilters: [")[1]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
def test_a_staged_run_works_the_inventory_out_once(spark):
    """Its writes bring the key sketches along: two jobs of writing, none of counting."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("staged", "two sources")
    lake = standin_lake(spark, SF_DIR, "netbox_device", "nutanix_host", "vmware_host")
    seen = []
    write = findings.staged

    def staged(frame, purpose, values):
        out = write(frame, purpose, values)
        seen.append((purpose, len(tracker.getJobIdsForGroup("staged")), "\n".join(final_lines(frame))))
        return out

    findings.staged = staged
    try:
        found = detect(checks.nutanix_host(TENANT), lake, AS_OF, 48, stage=True)
        ended = len(tracker.getJobIdsForGroup("staged"))
    finally:
        findings.staged = write
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [purpose for purpose, _, _ in seen] == ["inventory", "suspects"]
    assert ended == seen[-1][1]  # nothing runs besides the two writes
    (inventory, suspects) = (text for _, _, text in seen)
    assert "Window" in inventory and len(scans(inventory, "orders")) == 1
    assert "orders" not in suspects and "Window " not in suspects
    text = plan_of(found)
    assert not scans(text, "orders")  # the staged suspects stand for the inventory


def test_preview_is_cut_before_the_shuffle(large):
    text = plan(large, "preview_top20")
    assert "row_number(), 20, Partial" in text


def test_columns_are_pruned(large):
    (scan,) = scans(plan(large, "table_scan"), "orders")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp>" in scan
