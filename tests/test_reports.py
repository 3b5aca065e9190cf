from decimal import Decimal

import pytest
from conftest import AS_OF, at
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.plans import reports
from tidemark.sinks.history import append_findings, read_history, run_summary
from tidemark.sinks.tables import MONITORING_VM


def findings(spark, rows):
    """Rows of (id, type, age), in no particular order."""
    frame = spark.createDataFrame(rows, "id long, finding_type string, data_age_hours double")
    return frame.withColumn("data_age_hours", F.col("data_age_hours").cast("decimal(18,2)")).repartition(4)


MIXED = [
    (1, "STALE", 200.0), (2, "MISSING", None), (3, "STALE", 500.0), (4, "MISSING", 9.0), (5, "STALE", None),
    (6, "MISSING", 11.0), (7, "STALE", 500.0),
]


def test_order(spark):
    rows = ordering.ordered_findings(findings(spark, MIXED), ["id"]).collect()
    assert [r["id"] for r in rows] == [2, 6, 4, 5, 3, 7, 1]


def test_counts(spark):
    assert tuple(ordering.finding_counts(findings(spark, MIXED)).first()) == (7, 4, 3)
    assert tuple(ordering.finding_counts(findings(spark, [])).first()) == (0, 0, 0)


@pytest.mark.parametrize("stale", [0, 19, 20, 21, 50])
def test_preview(spark, stale):
    rows = [(i, "STALE", 169.0 + i) for i in range(stale)] + [(100 + i, "MISSING", None) for i in range(30)]
    frame = findings(spark, rows)
    preview = ordering.preview(frame, {"id": "record", "data_age_hours": "age"}, ["id"]).collect()
    for kind, want in (("STALE", [i for i in reversed(range(stale))][:20]), ("MISSING", list(range(100, 120)))):
        got = sorted((r["position"], int(r["record"])) for r in preview if r["finding_type"] == kind)
        assert got == list(enumerate(want, 1))
    assert {r["age"] for r in preview if r["finding_type"] == "MISSING"} == {"-"}
    assert {r["age_days"] for r in preview if r["finding_type"] == "MISSING"} == {"?"}
    remaining = {r["finding_type"]: (r["total"], r["remaining"]) for r in ordering.preview_remaining(frame).collect()}
    assert remaining == {"MISSING": (30, 10), **({"STALE": (stale, max(stale - 20, 0))} if stale else {})}


def write_history(spark, location, checks):
    for time, kinds in checks:
        rows = [
            (at(time), f"vm{i}", k, Decimal(200 + i) if k == "STALE" else None, f"cluster{i}") for i, k in enumerate(kinds)
        ]
        frame = spark.createDataFrame(
            rows,
            "check_time timestamp, netbox_vm_name string, finding_type string, data_age_hours decimal(10,2), netbox_cluster_name string",
        )
        append_findings(frame, location, MONITORING_VM)
    return read_history(spark, location, MONITORING_VM)


CHECKS = [
    ("2026-06-01T06:00:00", ["STALE"]),
    ("2026-06-14T06:00:00", ["STALE", "MISSING"]),
    ("2026-06-15T06:00:00", ["MISSING"] * 3),
    ("2026-06-15T23:30:00", ["STALE", "STALE", "MISSING", "STALE"]),
]


@pytest.mark.parametrize("partitioned", [True, False])
def test_history_reports(spark, tmp_path, partitioned):
    history = write_history(spark, str(tmp_path / "h"), CHECKS)
    if not partitioned:
        history = history.drop("check_date")
    assert sorted(map(tuple, reports.latest_check_summary(history).collect())) == [("MISSING", 1), ("STALE", 3)]
    stale = reports.latest_stale_list(history, ["netbox_vm_name", "data_age_hours"]).collect()
    assert [tuple(r) for r in stale] == [("vm3", 203), ("vm1", 201), ("vm0", 200)]
    trend = [(str(r["check_date"]), r["finding_type"], r["count"]) for r in reports.finding_trend(history).collect()]
    assert trend == [
        ("2026-06-15", "MISSING", 4), ("2026-06-15", "STALE", 3), ("2026-06-14", "MISSING", 1), ("2026-06-14", "STALE", 1),
        ("2026-06-01", "STALE", 1),
    ]
    week = reports.finding_trend(history, last_days=7, as_of=AS_OF).collect()
    assert [str(r["check_date"]) for r in week] == ["2026-06-15"] * 2 + ["2026-06-14"] * 2


def test_reports_open_the_runs_they_need_only(spark, tmp_path):
    location = str(tmp_path / "h")
    whole = write_history(spark, location, CHECKS)
    newest = read_history(spark, location, MONITORING_VM, newest=True)
    assert len(newest.inputFiles()) < len(whole.inputFiles())
    assert newest.count() == 4 and reports.latest_check(newest).count() == 4
    assert sorted(map(tuple, reports.latest_check_summary(newest).collect())) == [("MISSING", 1), ("STALE", 3)]
    week = read_history(spark, location, MONITORING_VM, since=at("2026-06-14").date())
    assert len(week.inputFiles()) < len(whole.inputFiles()) and week.count() == 9


def test_only_published_runs_count(spark, tmp_path):
    location = str(tmp_path / "h")
    history = write_history(spark, location, CHECKS)
    rows = history.count()
    history.limit(1).drop("check_date").write.parquet(f"{location}/runs/run-lost")  # a writer lost before publishing
    assert read_history(spark, location, MONITORING_VM).count() == rows
    summary = [tuple(r)[1:] for r in run_summary(spark, location).collect()]
    assert summary == [(1, 1, 0), (2, 1, 1), (3, 0, 3), (4, 3, 1)]
    assert read_history(spark, str(tmp_path / "none"), MONITORING_VM).count() == 0


def test_empty_history(spark, tmp_path):
    history = write_history(spark, str(tmp_path / "h"), CHECKS).where("finding_type = 'NONE'")
    assert reports.latest_check_summary(history).collect() == []
    assert reports.finding_trend(history).collect() == []


def test_table_report(spark):
    rows = [
        ("old", "2026-06-01 12:00:00", "336.00"), ("edge", "2026-06-08 12:00:00", "168.00"), ("none", None, None),
        ("zero", "2026-06-15 12:00:00", "0.00"), ("future", "2026-06-15 13:00:00", "-1.00"),
    ]
    frame = spark.createDataFrame(rows, "table_name string, t string, age string").select(
        "table_name",
        F.lit("c").alias("column_name"),
        F.col("t").cast("timestamp").alias("last_data_timestamp"),
        F.col("age").cast("decimal(10,2)").alias("data_age_hours"),
        F.concat(F.lit("item "), "table_name").alias("zabbix_item_name"),
        F.lit("1").alias("zabbix_item_id"),
    )
    assert [tuple(r) for r in reports.table_report(frame.repartition(3)).collect()] == [
        ("old", "c", "2026-06-01 12:00:00", "(336.0h)", "STALE"),
        ("edge", "c", "2026-06-08 12:00:00", "(168.0h)", ""),
        ("none", "c", "N/A", "", ""),
        ("zero", "c", "2026-06-15 12:00:00", "(0.0h)", ""),
        ("future", "c", "2026-06-15 13:00:00", "(-1.0h)", ""),
    ]
