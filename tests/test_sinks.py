import os

import pytest
from conftest import AS_OF, HOURS, at
from fleet import machines, observed
from pyspark.sql import functions as F

from tidemark.operators import items
from tidemark.plans import checks
from tidemark.plans.jobs import item_order, run_check, run_tables
from tidemark.plans import reports
from tidemark.sinks import history as log
from tidemark.sinks.contract import Contract, conform, violations
from tidemark.sinks.history import append_findings, append_run, fold_day, read_history, run_summary
from tidemark.sinks.state import StateTable
from tidemark.sinks.tables import MONITORING_CLUSTERS, MONITORING_VM, MONITORING_VMWARE_VM, TABLE_MONITORING
from tidemark.sources.responses import HOST_RESPONSE_SCHEMA, ITEM_RESPONSE_SCHEMA
from tidemark.sources.tables import Lake
from workload.standins import TENANT, standin_lake

SF_DIR = "/root/testdata/sf0.001"


def vm_lake(spark, inventory, seen=()):
    return Lake(
        spark,
        {
            "netbox_vm": machines(spark, inventory, tags1_display="Nutanix Acropolis", last_updated=at("2026-05-01")),
            "nutanix_vm": observed(spark, "nutanix_vm", list(seen)),
        },
    )


def data_files(location):
    return [f for _, _, files in os.walk(location) for f in files if f.endswith(".parquet")]


def finding(spark, **values):
    """One conforming VM finding with some values replaced."""
    row = {
        "check_time": F.lit(AS_OF),
        "netbox_vm_name": F.lit("vm"),
        "nutanix_component_moid": F.lit("m"),
        "data_age_hours": F.lit("1.5").cast("decimal(18,2)"),
        "finding_type": F.lit("STALE"),
        **values,
    }
    return spark.range(1).select(*[v.alias(k) for k, v in row.items()])


def broken_findings(spark):
    null = F.lit(None).cast("string")
    return {
        "check_time.not null": finding(spark, check_time=F.lit(None).cast("timestamp")),
        "netbox_vm_name.not null": finding(spark, netbox_vm_name=null),
        "finding_type.not null": finding(spark, finding_type=null),
        "finding_type.at most 20 characters": finding(spark, finding_type=F.lit("A" * 21)),
        "nutanix_component_moid.at most 255 characters": finding(spark, nutanix_component_moid=F.lit("m" * 256)),
        "data_age_hours.fits decimal(10,2)": finding(spark, data_age_hours=F.lit("99999999.995").cast("decimal(18,3)")),
        "netbox_disk.fits bigint": finding(spark, netbox_disk=F.lit("9223372036854775807.5").cast("decimal(25,1)")),
    }


def test_contract_violations_fail_the_whole_write(spark, tmp_path):
    history = str(tmp_path / "history")
    assert append_findings(finding(spark), history, MONITORING_VM) == 1
    before = data_files(history)
    for rule, broken in broken_findings(spark).items():
        column, what = rule.split(".", 1)
        found = violations(broken, MONITORING_VM).collect()
        assert [tuple(r) for r in found] == [(column, what, 1)], rule
        both = finding(spark).unionByName(broken, allowMissingColumns=True)
        with pytest.raises(Exception, match="monitoring_vm"):
            append_findings(both, history, MONITORING_VM)
    assert data_files(history) == before
    assert read_history(spark, history, MONITORING_VM).count() == 1


def test_contract_types_and_defaults(spark):
    frame = finding(
        spark,
        netbox_vcpus=F.lit("2.5").cast("decimal(10,2)"),
        netbox_memory=F.lit("-2.5").cast("decimal(10,2)"),
        netbox_disk=F.lit(7),
        nutanix_component_moid=F.lit("m" * 255),
        data_age_hours=F.lit("99999999.994").cast("decimal(18,3)"),
        surplus=F.lit(1),
    )
    out = conform(frame, MONITORING_VM)
    assert out.columns == MONITORING_VM.columns
    assert out.dtypes == [(f.name, f.type) for f in MONITORING_VM.fields]
    row = out.first()
    assert (row["netbox_vcpus"], row["netbox_memory"], row["netbox_disk"]) == (3, -3, 7)
    assert str(row["data_age_hours"]) == "99999999.99"
    assert row["check_threshold_hours"] == 168 and row["notes"] is None
    assert violations(frame, MONITORING_VM).count() == 0
    assert conform(frame.drop("check_time"), MONITORING_VM).where("check_time is not null").count() == 1
    # A default stands in for a missing column, not for a NULL.
    unset = frame.withColumn("check_threshold_hours", F.lit(None).cast("int"))
    assert [tuple(r) for r in violations(unset, MONITORING_VM).collect()] == [("check_threshold_hours", "not null", 1)]


def test_a_null_cluster_name_fails(spark):
    frame = spark.range(1).select(
        F.lit(AS_OF).alias("check_time"), F.lit(None).cast("string").alias("netbox_cluster_name"), F.lit("MISSING").alias("finding_type")
    )
    with pytest.raises(Exception, match="netbox_cluster_name must be: not null"):
        conform(frame, MONITORING_CLUSTERS).collect()


def test_runs_append_and_dry_runs_do_not(spark, tmp_path):
    history = str(tmp_path / "history")
    lake = vm_lake(spark, [{"id": 1, "custom_fields_uuid": "a"}, {"id": 2, "custom_fields_uuid": "b"}])
    dry = run_check(checks.NUTANIX_VM, lake, history, AS_OF, HOURS, dry_run=True)
    assert dry.written is None and dry.findings.count() == 2 and not os.path.exists(history)
    for day in (15, 16):
        assert run_check(checks.NUTANIX_VM, lake, history, at(f"2026-06-{day}"), HOURS).written == 2
    rows = read_history(spark, history, MONITORING_VM)
    assert rows.count() == 4
    assert sorted(str(r[0]) for r in rows.select("check_date").distinct().collect()) == ["2026-06-15", "2026-06-16"]
    with pytest.raises(ValueError):
        run_check(checks.NUTANIX_VM, lake)


def test_a_healthy_fleet_writes_no_data(spark, tmp_path):
    seen = [{"component_moid": "a", "last_observed": AS_OF}]
    for name, inventory in (("healthy", [{"id": 1, "custom_fields_uuid": "a"}]), ("empty", [])):
        history = str(tmp_path / name)
        assert run_check(checks.NUTANIX_VM, vm_lake(spark, inventory, seen), history, AS_OF, HOURS).written == 0
        assert data_files(history) == []


def test_unbounded_numbers_are_kept_exactly_or_refused(spark, tmp_path):
    """The machine check's vcpus have no declared size, so a number our type would change fails the write."""
    history = str(tmp_path / "history")

    def vmware(value, kind):
        return finding(spark, netbox_vcpus=F.lit(value).cast(kind), vmware_component_moid=F.lit("m"))

    for value, kind in (("1.234567", "decimal(20,8)"), ("2.5", "double"), ("-0.1", "double"), ("7", "int"), (None, "double")):
        assert append_findings(vmware(value, kind), history, MONITORING_VMWARE_VM) == 1
    before = data_files(history)
    for value, kind in (("1.23456789", "decimal(20,8)"), ("1.23456789", "double"), ("1e35", "double"), ("NaN", "double")):
        broken = vmware(value, kind)
        found = [tuple(r) for r in violations(broken, MONITORING_VMWARE_VM).collect()]
        assert found == [("netbox_vcpus", "kept exactly by decimal(38,6)", 1)], value
        with pytest.raises(Exception, match="netbox_vcpus must be: kept exactly"):
            append_findings(broken, history, MONITORING_VMWARE_VM)
    assert data_files(history) == before
    kept = {str(r.netbox_vcpus) for r in read_history(spark, history, MONITORING_VMWARE_VM).collect()}
    assert kept == {"1.234567", "2.500000", "-0.100000", "7.000000", "None"}


def test_a_repeated_key_fails_the_write(spark, tmp_path):
    keyed = Contract("keyed", (*MONITORING_VM.fields,), unique=("netbox_vm_id", "netbox_vm_name"))
    history = str(tmp_path / "history")
    rows = finding(spark, netbox_vm_id=F.lit(1)).union(finding(spark, netbox_vm_id=F.lit(2)))
    assert append_findings(rows, history, keyed) == 2
    before = data_files(history)
    with pytest.raises(Exception, match=r"keyed.\(netbox_vm_id, netbox_vm_name\) must be: unique"):
        append_findings(rows.union(finding(spark, netbox_vm_id=F.lit(2))), history, keyed)
    assert data_files(history) == before
    assert read_history(spark, history, keyed).count() == 2


def test_a_run_that_found_nothing_is_in_the_log_only(spark, tmp_path):
    history = str(tmp_path / "history")
    lake = vm_lake(spark, [{"id": 1, "custom_fields_uuid": "a"}], [{"component_moid": "a", "last_observed": at("2026-06-15")}])
    assert run_check(checks.NUTANIX_VM, lake, history, at("2026-06-25"), HOURS).written == 1
    healthy = run_check(checks.NUTANIX_VM, lake, history, at("2026-06-16"), HOURS)
    assert (healthy.written, healthy.stale, healthy.missing) == (0, 0, 0)
    assert run_check(checks.NUTANIX_VM, lake, history, at("2026-06-15"), HOURS).written == 0
    summary = [(str(r.check_time.date()), r.total, r.stale, r.missing) for r in run_summary(spark, history).collect()]
    assert summary == [("2026-06-15", 0, 0, 0), ("2026-06-16", 0, 0, 0), ("2026-06-25", 1, 1, 0)]
    # The newest check is the newest with findings, as a maximum over rows has it.
    assert read_history(spark, history, MONITORING_VM, newest=True).count() == 1
    assert run_check(checks.NUTANIX_VM, lake, history, at("2026-06-17"), HOURS).written == 0
    assert read_history(spark, history, MONITORING_VM).count() == 1
    assert len(data_files(history)) == 1


def runs_of_a_day(spark, history, *hours):
    for hour in hours:
        rows = finding(spark, check_time=F.lit(at(f"2026-06-15T{hour:02d}:00:00")), netbox_vm_name=F.lit(f"vm{hour}"))
        append_run(rows.unionByName(rows.withColumn("finding_type", F.lit("MISSING"))), history, MONITORING_VM)


def names(frame):
    return sorted(r.netbox_vm_name for r in frame.collect())


def test_a_folded_day_gives_each_row_once(spark, tmp_path):
    history = str(tmp_path / "history")
    append_findings(finding(spark, check_time=F.lit(at("2026-06-14"))), history, MONITORING_VM)
    runs_of_a_day(spark, history, 1, 2, 3)
    day = at("2026-06-15").date()
    whole = names(read_history(spark, history, MONITORING_VM))
    newest = names(read_history(spark, history, MONITORING_VM, newest=True))
    assert newest == ["vm3", "vm3"] and len(whole) == 7
    began = read_history(spark, history, MONITORING_VM)  # a reader that has listed the log before
    assert fold_day(spark, history, MONITORING_VM, at("2026-06-14").date()) == 0  # one run
    assert fold_day(spark, history, MONITORING_VM, day) == 3
    assert names(began) == whole
    folded = read_history(spark, history, MONITORING_VM)
    assert names(folded) == whole and folded.columns == began.columns
    assert len([f for f in folded.inputFiles() if "/days/" in f]) == 1 and len(folded.inputFiles()) == 2
    last = read_history(spark, history, MONITORING_VM, newest=True)
    assert names(last) == newest and all("/days/" in f for f in last.inputFiles())
    # Runs that come later keep their own folder until the day is folded again.
    runs_of_a_day(spark, history, 4)
    assert names(read_history(spark, history, MONITORING_VM)) == sorted([*whole, "vm4", "vm4"])
    assert names(read_history(spark, history, MONITORING_VM, newest=True)) == ["vm4", "vm4"]
    assert fold_day(spark, history, MONITORING_VM, day) == 4
    again = read_history(spark, history, MONITORING_VM)
    assert names(again) == sorted([*whole, "vm4", "vm4"])
    assert not [f for f in again.inputFiles() if "/runs/" in f and "06-15" in f]


def test_a_reader_between_listing_and_folding_sees_its_runs_only(spark, tmp_path):
    history = str(tmp_path / "history")
    runs_of_a_day(spark, history, 1, 2)
    listed = log.runs(spark, history)
    runs_of_a_day(spark, history, 3)
    fold_day(spark, history, MONITORING_VM, at("2026-06-15").date())
    assert names(log._read(spark, history, MONITORING_VM, listed)) == ["vm1", "vm1", "vm2", "vm2"]


def test_trend_and_summary_come_from_the_log(spark, tmp_path):
    history = str(tmp_path / "history")
    append_findings(finding(spark, check_time=F.lit(at("2026-06-14"))), history, MONITORING_VM)
    runs_of_a_day(spark, history, 1, 2)
    trend = reports.logged_trend(spark, history, MONITORING_VM)
    rows = read_history(spark, history, MONITORING_VM)
    assert trend.collect() == reports.finding_trend(rows).collect() and trend.columns == reports.finding_trend(rows).columns
    assert [tuple(r)[1:] for r in trend.collect()] == [("MISSING", 2), ("STALE", 2), ("STALE", 1)]
    recent = reports.logged_trend(spark, history, MONITORING_VM, last_days=1, as_of=AS_OF)
    assert recent.collect() == reports.finding_trend(rows, last_days=1, as_of=AS_OF).collect()
    summary = reports.logged_summary(spark, history, MONITORING_VM)
    assert sorted(summary.collect()) == sorted(reports.latest_check_summary(rows).collect())
    for frame in (trend, summary):
        assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()
    # A type the log doesn't tell apart is counted from its run.
    append_findings(finding(spark, check_time=F.lit(at("2026-06-16")), finding_type=F.lit("ODD")), history, MONITORING_VM)
    assert [tuple(r)[1:] for r in reports.logged_trend(spark, history, MONITORING_VM).collect()][0] == ("ODD", 1)
    empty = str(tmp_path / "none")
    assert reports.logged_trend(spark, empty, MONITORING_VM).collect() == []


def test_findings_of_two_instants_are_no_run(spark, tmp_path):
    history = str(tmp_path / "history")
    rows = finding(spark).unionByName(finding(spark, check_time=F.lit(at("2026-06-14"))))
    with pytest.raises(ValueError, match="one check_time"):
        append_run(rows, history, MONITORING_VM)
    assert data_files(history) == [] and log.runs(spark, history) == []


STATE = "table_name string, column_name string, zabbix_host string, zabbix_item_id string, check_time timestamp, last_clock long"


def batch(spark, *rows):
    return spark.createDataFrame([(t, "ts", "h", item, AS_OF, clock) for t, item, clock in rows], STATE)


def current(state):
    return sorted((r["table_name"], r["zabbix_item_id"], r["last_clock"]) for r in state.current().collect())


def test_repeated_keys_are_violations(spark):
    rows = batch(spark, ("a", "1", 5), ("a", "2", 9), ("a", "3", None), ("b", "4", 1))
    found = [tuple(r) for r in violations(rows, TABLE_MONITORING).collect()]
    assert found == [("table_name, column_name", "unique", 2)]
    assert violations(rows.where("zabbix_item_id > '2'"), TABLE_MONITORING).count() == 0


def upsert(state, frame):
    return state.upsert(frame, newest="last_clock", tiebreak=item_order())


def test_upsert(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    assert current(state) == []
    first = batch(spark, ("a", "1", 5), ("a", "2", 9), ("a", "3", None), ("b", "4", 1), ("c", "6", 2), ("c", "5", 2))
    assert upsert(state, first) == 3
    assert current(state) == [("a", "2", 9), ("b", "4", 1), ("c", "5", 2)]
    assert upsert(state, first) == 3
    assert current(state) == [("a", "2", 9), ("b", "4", 1), ("c", "5", 2)]
    # Known keys are replaced even by an older clock, new ones come in, others stay.
    assert upsert(state, batch(spark, ("a", "7", 1), ("d", "8", None))) == 2
    expected = [("a", "7", 1), ("b", "4", 1), ("c", "5", 2), ("d", "8", None)]
    assert current(state) == expected
    assert upsert(state, batch(spark)) == 0
    assert current(state) == expected
    state.create()
    assert current(StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING)) == expected


def test_a_failing_upsert_changes_nothing(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    upsert(state, batch(spark, ("a", "1", 5)))
    with pytest.raises(Exception, match="table_name must be: not null"):
        upsert(state, batch(spark, ("a", "2", 6), (None, "3", 7)))
    assert current(state) == [("a", "1", 5)]
    with pytest.raises(ValueError):
        StateTable(spark, str(tmp_path / "other"), MONITORING_VM)


def answers(spark, schema, text):
    return spark.createDataFrame([(text,)], "t string").select(F.from_json("t", schema).alias("r")).select("r.*")


def test_table_run(spark, tmp_path):
    tags = '"hostid":"1","tags":[{"tag":"last data"}]'
    item_answers = answers(
        spark,
        ITEM_RESPONSE_SCHEMA,
        '{"result":['
        f'{{"itemid":"1","name":"Table [a]: Last data timestamp (t)","lastvalue":"2026-06-15 10:30:00","lastclock":"5",{tags}}},'
        f'{{"itemid":"2","name":"Table [b]: Last data timestamp (t)","lastvalue":"junk","lastclock":"x",{tags}}},'
        f'{{"itemid":"3","name":"Table [c]: Last data timestamp (t)","lastvalue":"0",{tags}}},'
        f'{{"itemid":"4","name":"no table","lastvalue":"0",{tags}}}]}}',
    )
    host_answers = answers(spark, HOST_RESPONSE_SCHEMA, '{"result":[{"hostid":"1","host":"db-master"}]}')
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    dry = run_tables(item_answers, host_answers, as_of=AS_OF, dry_run=True)
    assert dry.written is None and dry.findings.count() == 3
    run = run_tables(item_answers, host_answers, state, AS_OF)
    assert (run.written, run.parsed, run.skipped, run.stale) == (3, 3, 1, 1)
    assert run.findings.count() == 3  # the plan may be asked again
    rows = {r["table_name"]: r for r in state.current().collect()}
    assert {k: (str(r["data_age_hours"]), r["last_clock"]) for k, r in rows.items()} == {
        "a": ("1.50", 5), "b": ("None", None), "c": ("494868.00", None),
    }
    assert rows["a"]["zabbix_host"] == "db-master" and rows["b"]["last_data_timestamp"] is None
    assert tuple(items.stale_table_count(state.current()).first()) == (3, 1)
    with pytest.raises(ValueError):
        run_tables(item_answers, host_answers)


def test_no_items_is_a_success(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    item_answers = answers(spark, ITEM_RESPONSE_SCHEMA, '{"result":[]}')
    host_answers = answers(spark, HOST_RESPONSE_SCHEMA, '{"result":[{"hostid":"1","host":"db-master"}]}')
    run = run_tables(item_answers, host_answers, state, AS_OF)
    assert (run.written, run.parsed, run.skipped, run.stale) == (0, 0, 0, 0)
    assert current(state) == []


def test_overlapping_writers_keep_both_batches(spark, tmp_path):
    root = str(tmp_path / "state")
    first, second = (StateTable(spark, root, TABLE_MONITORING).create() for _ in range(2))
    upsert(first, batch(spark, ("a", "1", 5)))
    publish = first._publish

    def late(manifest):
        first._publish = publish
        upsert(second, batch(spark, ("b", "2", 6)))  # takes the version between merge and publishing
        return publish(manifest)

    first._publish = late
    assert upsert(first, batch(spark, ("c", "3", 7))) == 1
    assert current(second) == [("a", "1", 5), ("b", "2", 6), ("c", "3", 7)]


def folders(root, kind):
    """Folders of one kind, each with the buckets it has files of."""
    return {
        name: sorted(b for b in os.listdir(root / name) if b.startswith("state_bucket="))
        for name in os.listdir(root)
        if name.startswith(kind)
    }


def test_an_upsert_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    root = tmp_path / "state"
    state = StateTable(spark, str(root), TABLE_MONITORING).create(buckets=64)
    upsert(state, batch(spark, *[(f"t{i}", str(i), i) for i in range(1000)]))
    (whole,) = folders(root, "batch").values()
    assert len(whole) == 64 and folders(root, "merge") == {}  # nothing to merge over yet
    assert upsert(state, batch(spark, ("t7", "x", 5))) == 1
    (merge,) = folders(root, "merge").values()
    assert len(merge) == 1
    before, after = state._published().folders, None
    assert upsert(state, batch(spark, ("t7", "y", 6), ("new", "z", 1))) == 2
    after = state._published().folders
    assert len([b for b in after if after[b] != before[b]]) <= 2
    rows = {r["table_name"]: r["zabbix_item_id"] for r in state.current().collect()}
    assert len(rows) == 1001
    assert rows["t7"] == "y" and rows["new"] == "z" and all(rows[f"t{i}"] == str(i) for i in range(1000) if i != 7)


def test_rows_of_keys_read_their_buckets_only(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create(buckets=64)
    assert state.rows_of([("t1", "ts")]).collect() == []
    upsert(state, batch(spark, *[(f"t{i}", str(i), i) for i in range(1000)]))
    some = state.rows_of([("t5", "ts"), ("t5", "ts"), ("none", "ts")])
    assert [(r["table_name"], r["last_clock"]) for r in some.collect()] == [("t5", 5)]
    assert some.columns == TABLE_MONITORING.columns
    read = {os.path.dirname(f) for f in some.inputFiles()}
    assert 1 <= len(read) <= 2


def test_a_state_keeps_its_number_of_buckets(spark, tmp_path):
    root = str(tmp_path / "state")
    state = StateTable(spark, root, TABLE_MONITORING).create(buckets=3)
    upsert(state, batch(spark, ("a", "1", 5), ("b", "2", 6), ("c", "3", 7)))
    again = StateTable(spark, root, TABLE_MONITORING).create(buckets=50)
    upsert(again, batch(spark, ("b", "4", 1)))
    assert again._published().buckets == 3
    assert current(again) == [("a", "1", 5), ("b", "4", 1), ("c", "3", 7)]


def test_a_lost_race_merges_again_only_what_both_touched(spark, tmp_path):
    root = tmp_path / "state"
    first, second = (StateTable(spark, str(root), TABLE_MONITORING).create(buckets=64) for _ in range(2))
    upsert(first, batch(spark, *[(f"t{i}", str(i), i) for i in range(300)]))
    publish = first._publish

    def late(manifest):
        first._publish = publish
        upsert(second, batch(spark, ("t1", "other", 1)))
        return publish(manifest)

    first._publish = late
    upsert(first, batch(spark, *[(f"t{i}", "mine", i) for i in range(20, 30)], ("t1", "mine", 0)))
    sizes = sorted(len(b) for b in folders(root, "merge").values())
    assert sizes[:2] == [1, 1] and 5 < sizes[2] <= 11  # the other's, the one merged again, the first try
    rows = {r["table_name"]: r["zabbix_item_id"] for r in first.current().collect()}
    assert rows["t1"] == "mine" and rows["t25"] == "mine" and rows["t99"] == "99" and len(rows) == 300


def test_a_state_must_be_created(spark, tmp_path):
    (tmp_path / "state" / "log").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="create"):
        StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).current()


def test_unfinished_entries_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.state.PATIENCE", 1)
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    upsert(state, batch(spark, ("a", "1", 5)))
    (tmp_path / "state" / "log" / "2").touch()
    with pytest.raises(RuntimeError, match="unfinished"):
        upsert(state, batch(spark, ("b", "2", 6)))


def test_the_lower_item_number_settles_equal_clocks(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    upsert(state, batch(spark, ("a", "10000", 5), ("a", "9999", 5), ("a", "x", 5)))
    assert current(state) == [("a", "9999", 5)]


def test_the_name_settles_equal_clocks_before_the_number(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), TABLE_MONITORING).create()
    names = F.when(F.col("zabbix_item_id") == "2", "Table [a]: x").otherwise(" table  [a]: x")
    upsert(state, batch(spark, ("a", "1", 5), ("a", "2", 5), ("a", "3", 5)).withColumn("zabbix_item_name", names))
    assert current(state) == [("a", "1", 5)]
    upsert(state, batch(spark, ("a", "4", 5), ("a", "5", 5)).withColumn(
        "zabbix_item_name", F.when(F.col("zabbix_item_id") == "5", "Table [a]: x").otherwise("table [a]: x")))
    assert current(state) == [("a", "5", 5)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
def test_a_dry_run_of_two_sources_writes_nothing(spark, monkeypatch):
    def written(*_):
        raise AssertionError("a dry run wrote its suspects")

    monkeypatch.setattr("tidemark.operators.findings.staged", written)
    lake = standin_lake(spark, SF_DIR, "netbox_device", "nutanix_host", "vmware_host")
    assert run_check(checks.nutanix_host(TENANT), lake, as_of=AS_OF, threshold_hours=48, dry_run=True).written is None
