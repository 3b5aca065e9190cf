import json
import os
from datetime import timedelta

import pytest
from conftest import AS_OF, HOURS, at
from fleet import machines
from pyspark.sql import functions as F

from tidemark.plans import checks
from tidemark.plans.jobs import run_check
from tidemark.session import scratch_dir
from tidemark.sinks.history import read_history
from tidemark.sources import pages, responses
from tidemark.sources.lists import list_relation
from tidemark.sources.tables import ByHash, ByRange, Lake, TableSource, jdbc, parquet


def land(folder, *objects, lines=True):
    folder.mkdir()
    if lines:
        (folder / "part.json").write_text("\n".join(json.dumps(o) for o in objects))
    else:
        for i, o in enumerate(objects):
            (folder / f"{i}.json").write_text(json.dumps(o, indent=2))
    return str(folder)


PAGES = [
    {
        "next": "/clusters?page=2",
        "results": [
            {"id": 1, "display": "c1", "name": "n1", "type": {"display": "Acropolis", "slug": "acropolis-cls"}},
            {"id": 2, "display": "", "name": "n2", "type": {"display": "Acropolis", "slug": "acropolis-cls"}},
        ],
    },
    {
        "next": None,
        "results": [
            {"id": 3, "name": "n3", "type": {"display": "Other", "slug": "other"}, "extra": [1]},
            {"id": 4, "display": "c4", "type": None},
            {"id": 5, "display": None, "name": None},
        ],
    },
    {"next": None, "results": []},
    {"next": None},
]


@pytest.mark.parametrize("lines", [True, False])
def test_pages(spark, tmp_path, lines):
    location = land(tmp_path / "pages", *PAGES, lines=lines)
    records = pages.page_records(pages.read_pages(spark, location, multiline=not lines))
    assert sorted(map(tuple, records.collect())) == [
        (1, "c1", "Acropolis", "acropolis-cls"),
        (2, "n2", "Acropolis", "acropolis-cls"),
        (3, "n3", "Other", "other"),
        (4, "c4", None, None),
        (5, None, None, None),
    ]
    kept = pages.cluster_inventory(spark, location, multiline=not lines, chained=False)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]


def test_a_broken_page_fails(spark, tmp_path):
    location = land(tmp_path / "pages", PAGES[0])
    (tmp_path / "pages" / "cut.json").write_text('{"next": null, "results": [{"id"')
    with pytest.raises(Exception, match="(?i)malformed"):
        pages.page_records(pages.read_pages(spark, location)).collect()


def chain(*links, size=1, count=None):
    """Pages of (url, next), with ``size`` records each."""
    return [
        {"url": url, "next": following, "count": count, "results": [{"id": 10 * n + k, "name": "n"} for k in range(size)]}
        for n, (url, following) in enumerate(links)
    ]


WHOLE = [("1", "2"), ("2", "3"), ("3", None)]


@pytest.mark.parametrize(
    "landed, faults",
    [
        (chain(*WHOLE, count=3), {}),
        (chain(*WHOLE, size=2, count=6), {}),
        (chain(("1", None)), {}),
        ([], {}),
        (chain(*reversed(WHOLE)), {}),
        (chain(WHOLE[0], WHOLE[2]), {"missing": 1, "beginnings": 1}),
        (chain(*WHOLE[:2]), {"missing": 1}),
        (chain(*WHOLE[1:], count=3), {"short": 1}),
        (chain(*WHOLE, WHOLE[1]), {"repeated": 1, "forked": 1}),
        (chain(*WHOLE, WHOLE[2], count=3), {"repeated": 1, "short": -1}),
        (chain(*WHOLE, ("4", "2")), {"forked": 1, "beginnings": 1}),
        (chain(*WHOLE, ("8", "9"), ("9", "8"), count=3), {"short": -2}),
        (chain(("1", "2"), ("2", "1")), {"beginnings": -1}),
        (chain((None, "2"), ("2", None)), {"beginnings": -1, "unnamed": 1}),
    ],
)
def test_page_chains(spark, tmp_path, landed, faults):
    frame = pages.read_pages(spark, land(tmp_path / "pages", *landed))
    assert {k: v for k, v in pages.chain_faults(frame).first().asDict().items() if v} == faults
    whole = pages.page_records(pages.whole_chain(frame))
    if not faults:
        assert whole.count() == sum(len(p["results"]) for p in landed)
        return
    told = ", ".join(f"{k} {v}" for k, v in faults.items())
    with pytest.raises(Exception, match=f"no whole chain: {told}"):
        whole.collect()


ITEM = {"itemid": "7", "name": "n", "lastvalue": 12, "lastclock": "5", "hostid": "1", "tags": [{"tag": "a"}, {"tag": "last data"}]}
HOSTS = {"result": [{"hostid": "1", "host": "db-master"}, {"hostid": "2", "host": "db-master-2"}]}


def item_frame(spark, tmp_path, *answers):
    return responses.read_responses(spark, land(tmp_path / "items", *answers), responses.ITEM_RESPONSE_SCHEMA)


def host_frame(spark, tmp_path, answer=HOSTS):
    return responses.read_responses(spark, land(tmp_path / "hosts", answer), responses.HOST_RESPONSE_SCHEMA)


def test_items(spark, tmp_path):
    other = [{**ITEM, "itemid": "8", "hostid": "2"}, {**ITEM, "itemid": "9", "tags": []}, {**ITEM, "itemid": "10", "tags": None}]
    answers = item_frame(spark, tmp_path, {"result": [ITEM, *other]}, {"result": []}, {"result": None})
    items = responses.results_or_fail(answers)
    assert items.count() == 4
    hosts = responses.results_or_fail(host_frame(spark, tmp_path))
    mine = responses.items_with_tag(responses.items_of_host(items, hosts))
    assert list(map(tuple, responses.item_feed(mine).collect())) == [("7", "n", "12", "5")]
    assert responses.error_envelopes(answers).count() == 0


def test_an_error_response_fails(spark, tmp_path):
    error = {"code": -32602, "message": "Invalid params.", "data": "No permissions"}
    answers = item_frame(spark, tmp_path, {"result": [ITEM]}, {"error": error})
    assert [r.asDict() for r in responses.error_envelopes(answers).collect()] == [error]
    with pytest.raises(Exception, match=r"\[-32602\]: Invalid params. - No permissions"):
        responses.results_or_fail(answers).select("itemid").collect()
    with pytest.raises(Exception, match="-32602"):
        responses.results_or_fail(answers).count()


def test_an_unknown_host_fails(spark, tmp_path):
    items = responses.results_or_fail(item_frame(spark, tmp_path, {"result": [ITEM]}))
    hosts = responses.results_or_fail(host_frame(spark, tmp_path))
    with pytest.raises(Exception, match="no monitored host named 'db-slave'"):
        responses.items_of_host(items, hosts, "db-slave").collect()


def test_lists(spark):
    assert [r[0] for r in list_relation(spark, ["b", "a", "b"]).collect()] == ["b", "a", "b"]
    assert list_relation(spark, []).count() == 0


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "table"])
def test_wall_clocks_load_as_utc_instants(spark, tmp_path, format):
    frame = spark.sql("select 1L as id, timestamp_ntz'2026-06-10 12:55:00' as t")
    if format == "table":
        frame.write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("wall_clock")
        source = TableSource("table", "wall_clock")
    elif format == "json":
        frame.write.format(format).save(str(tmp_path / "t"))
        source = TableSource(format, str(tmp_path / "t"), {"inferTimestamp": "true"})
    else:
        frame.write.format(format).save(str(tmp_path / "t"))
        source = TableSource(format, str(tmp_path / "t"))
    loaded = Lake(spark, {"t": source}).table("t")
    assert dict(loaded.dtypes)["t"] == "timestamp"
    seconds = loaded.select(F.unix_seconds("t")).first()[0]
    assert seconds == at("2026-06-10T12:55:00").timestamp()
    if format == "table":
        spark.sql("drop table wall_clock")


def test_time_filters_reach_the_files(spark, tmp_path):
    spark.sql("select id, timestamp_ntz'2026-06-10 12:55:00' as t from range(10)").write.parquet(str(tmp_path / "t"))
    loaded = Lake(spark, {"t": parquet(str(tmp_path / "t"))}).table("t")
    old = loaded.where(F.col("t") < F.timestamp_micros(F.lit(1_700_000_000_000_000))).select("id")
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(t," in plan


def test_lake_refuses_unknown_roles(spark):
    with pytest.raises(KeyError, match="netbox_vm"):
        Lake(spark, {"a": spark.range(1)}).table("netbox_vm")


URL = "jdbc:postgresql://db/lake"


def test_a_database_table_is_read_in_parts_or_by_choice_over_one_connection():
    for arguments in ({}, {"by": ByRange("id", 4), "single_connection": True}, {"by": ByHash("id", 0)}):
        with pytest.raises(ValueError):
            jdbc(URL, "vm", **arguments)
    for option in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "dbtable", "query"):
        with pytest.raises(ValueError, match=option):
            jdbc(URL, "vm", single_connection=True, **{option: "x"})
    one = jdbc(URL, "vm", single_connection=True, fetchsize="1000")
    assert one.by is None and one.options == {"fetchsize": "1000"} and one.may_change


def test_ranges_come_from_the_least_and_greatest_value():
    source = jdbc(URL, "lake.vm", by=ByRange("id", 3))
    assert source.bounds_query() == "select min(id) as least, max(id) as most from lake.vm"
    assert source.bounds(1, 90) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "90", "numPartitions": "3"}
    assert source.bounds(None, None) == {}
    day = jdbc(URL, "vm", by=ByRange("seen", 2)).bounds(at("2026-01-01").date(), at("2026-02-01").date())
    assert (day["lowerBound"], day["upperBound"]) == ("2026-01-01", "2026-02-01")


def test_every_row_is_in_one_part_by_hash(spark):
    by = ByHash("k", 5, hash_sql="pmod(hash({column}), 1000)")
    rows = spark.createDataFrame([(f"k{i % 70}" if i % 9 else None,) for i in range(700)], "k string")
    parts = [rows.where(p).count() for p in by.predicates()]
    assert len(parts) == 5 and sum(parts) == 700 and min(parts) > 0
    assert rows.where(by.predicates()[0]).where("k is null").count() == 78
    default = ByHash("uuid", 2).predicates()
    assert default[0] == "((hashtext(cast(uuid as text)) & 2147483647) % 2 = 0 or uuid is null)"
    assert default[1] == "((hashtext(cast(uuid as text)) & 2147483647) % 2 = 1 and uuid is not null)"


def test_a_source_that_changes_between_two_branches_gives_one_label(spark, tmp_path):
    """Every read of the view tells another time for each machine, and may leave it out."""
    seen = """select 'u' || id as component_moid, 'on' as status, 's' as status_description, 'n' as nutanix_uuid,
              'os' as guest_os, 1L as memory_mb, 1 as num_vcpus,
              case when rand() < 0.5 then timestamp '2026-06-15' else timestamp '2026-05-01' end as last_observed
              from range(400) where rand() < 0.7"""
    spark.sql(f"create or replace temporary view changing as {seen}")
    inventory = machines(
        spark, [{"id": i, "custom_fields_uuid": f"u{i}"} for i in range(400)],
        tags1_display="Nutanix Acropolis", last_updated=at("2026-05-01"),
    )
    source = TableSource("table", "changing")
    assert source.may_change and not parquet("x").may_change and not TableSource("table", "t", live=False).may_change
    lake = Lake(spark, {"netbox_vm": inventory, "nutanix_vm": source})
    history = str(tmp_path / "history")
    assert run_check(checks.NUTANIX_VM, lake, history, AS_OF, HOURS).written > 0
    rows = read_history(spark, history, checks.NUTANIX_VM.contract).collect()
    found = {}
    for r in rows:
        found.setdefault(r.netbox_custom_fields_uuid, []).append(r)
    assert all(len(r) == 1 for r in found.values())
    landed = [f for f in os.listdir(spark.conf.get("spark.checkpoint.dir")) if f.startswith("pinned-nutanix_vm")]
    newest = max(landed, key=lambda f: os.path.getmtime(os.path.join(spark.conf.get("spark.checkpoint.dir"), f)))
    copy = {r.component_moid: r for r in spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/{newest}").collect()}
    assert "memory_mb" in next(iter(copy.values())) and len(copy) < 400
    for i in range(400):  # the labels are those of the copy
        label = found.get(f"u{i}", [None])[0]
        if f"u{i}" not in copy:
            assert label.finding_type == "MISSING"
        elif copy[f"u{i}"].last_observed < limit(HOURS):
            assert label.finding_type == "STALE"
        else:
            assert label is None


def limit(hours):
    return (AS_OF - timedelta(hours=hours)).replace(tzinfo=None)
