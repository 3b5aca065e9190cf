"""Edge cases of the host and cluster checks."""

from decimal import Decimal

import pytest
from conftest import AS_OF, HOURS, at
from fleet import clusters, devices, observed

from tidemark.plans import checks
from tidemark.plans.jobs import detect
from tidemark.sources.tables import Lake

TENANT = "Operations"
NONE = "no row"
SINCE_1970 = Decimal("494868.00")


def host_finding(spark, check, a, b, **device):
    """The finding of one device; ``a`` and ``b`` are the times the first and
    second source of the check saw it, NONE for no row."""
    nutanix, vmware = (a, b) if check.sources[0].label == "NUTANIX" else (b, a)
    record = {"id": 1, "name": "h1", "serial": "s1", "tags1_display": "ESXI NUTANIX", "tenant_name": TENANT, **device}
    lake = Lake(
        spark,
        {
            "netbox_device": devices(spark, [record]),
            "nutanix_host": observed(spark, "nutanix_host", [] if nutanix is NONE else [{"serial": "s1", "last_observed": nutanix}]),
            "vmware_host": observed(
                spark,
                "vmware_host",
                [{"name": None, "last_observed": at("2026-06-14")}] * 2
                + ([] if vmware is NONE else [{"name": "h1", "last_observed": vmware}]),
            ),
        },
    )
    rows = detect(check, lake, AS_OF, HOURS).collect()
    assert len(rows) <= 1
    return [(r["finding_type"], r["data_age_hours"], r["most_recent_source"], r["most_recent_observed"]) for r in rows]


def cluster_rows(spark, names, a, b):
    lake = Lake(
        spark,
        {
            "netbox_cluster": clusters(spark, [{"id": i, "name": n} for i, n in enumerate(names)]),
            "nutanix_cluster": observed(spark, "nutanix_cluster", [] if a is NONE else [{"name": "c1", "last_observed": a}]),
            "vmware_cluster": observed(spark, "vmware_cluster", [] if b is NONE else [{"name": "c1", "last_observed": b}]),
        },
    )
    return detect(checks.CLUSTER, lake, AS_OF, HOURS).collect()


# a, b, finding, age, which source is the most recent, whether epoch and missing policies agree
HOST_CASES = [
    (NONE, NONE, "MISSING", SINCE_1970, None),
    (None, NONE, "STALE", SINCE_1970, None),
    (NONE, None, "STALE", SINCE_1970, None),
    (at("2026-06-01"), at("2026-06-02"), "STALE", Decimal("324.00"), 1),
    (at("2026-06-02"), at("2026-06-02"), "STALE", Decimal("324.00"), 0),
    (at("2026-06-01"), at("2026-06-14"), None, None, None),
    (None, at("2026-06-01"), "STALE", Decimal("348.00"), 1),
    (at("2026-06-01"), NONE, "STALE", Decimal("348.00"), 0),
    (at("2026-06-08T12:00:00"), NONE, None, None, None),
    (at("2026-06-08T11:59:59"), None, "STALE", Decimal("168.00"), 0),
]


@pytest.mark.parametrize("make", [checks.nutanix_host, checks.vmware_host])
@pytest.mark.parametrize("a, b, finding, age, source", HOST_CASES)
def test_host(spark, make, a, b, finding, age, source):
    check = make(TENANT)
    rows = host_finding(spark, check, a, b)
    if finding is None:
        assert rows == []
        return
    (kind, hours, label, last), = rows
    assert (kind, hours) == (finding, age)
    assert label == (None if source is None else check.sources[source].label)
    assert (last is None) == (source is None)


@pytest.mark.parametrize("a, b, finding, age, source", HOST_CASES)
def test_cluster(spark, a, b, finding, age, source):
    rows = cluster_rows(spark, ["c1"], a, b)
    if age == SINCE_1970:
        finding, age = "MISSING", None
    assert [(r["finding_type"], r["data_age_hours"]) for r in rows] == ([] if finding is None else [(finding, age)])
    for r in rows:
        assert r["most_recent_source"] == (None if source is None else ("NUTANIX", "VMWARE")[source])
        # A matched row without a time counts as missing but keeps its columns.
        assert r["nutanix_name"] == (None if a is NONE else "c1")


def test_repeated_cluster_names_stay_repeated(spark):
    rows = cluster_rows(spark, ["c1", "c1", "c2", None], at("2026-06-01"), NONE)
    assert sorted((r["netbox_cluster_id"], r["finding_type"]) for r in rows) == [
        (0, "STALE"), (1, "STALE"), (2, "MISSING"), (3, "MISSING"),
    ]


def test_no_clusters_no_findings(spark):
    assert cluster_rows(spark, [], at("2026-06-01"), NONE) == []


def test_device_filters(spark):
    nutanix, vmware = checks.nutanix_host(TENANT), checks.vmware_host(TENANT)
    for blank in ("", None):
        assert host_finding(spark, nutanix, NONE, NONE, serial=blank) == []
        # Kept here: a blank serial just cannot match.
        assert host_finding(spark, vmware, NONE, at("2026-06-14"), serial=blank)[0][0] == "MISSING"
    for tag, kept in (("HYPER-V", 1), ("hyper-v", 0), ("KLASIK MIMARI", 1), (None, 0), ("ESXI", 0)):
        assert len(host_finding(spark, vmware, NONE, NONE, tags1_display=tag)) == kept
        assert host_finding(spark, nutanix, NONE, NONE, tags1_display=tag) == []
    for check in (nutanix, vmware):
        assert host_finding(spark, check, NONE, NONE, tenant_name="Someone else") == []
        assert host_finding(spark, check, NONE, NONE, tenant_name=None) == []


def test_a_threshold_before_1970_leaves_unknown_times_healthy(spark):
    """Only unmatched records are findings then."""
    check = checks.nutanix_host(TENANT)
    lake = Lake(
        spark,
        {
            "netbox_device": devices(
                spark,
                [{"id": i, "name": f"h{i}", "serial": f"s{i}", "tags1_display": "ESXI NUTANIX", "tenant_name": TENANT} for i in (1, 2)],
            ),
            "nutanix_host": observed(spark, "nutanix_host", [{"serial": "s1", "last_observed": None}]),
            "vmware_host": observed(spark, "vmware_host", []),
        },
    )
    rows = detect(check, lake, AS_OF, 600_000).collect()
    assert [(r["netbox_serial"], r["finding_type"]) for r in rows] == [("s2", "MISSING")]


def test_columns_match_the_result_tables(spark):
    lake = Lake(
        spark,
        {
            "netbox_device": devices(spark, []),
            "netbox_cluster": clusters(spark, []),
            **{n: observed(spark, n, []) for n in ("nutanix_host", "vmware_host", "nutanix_cluster", "vmware_cluster")},
        },
    )
    for check, count in ((checks.nutanix_host(TENANT), 37), (checks.vmware_host(TENANT), 38), (checks.CLUSTER, 21)):
        columns = detect(check, lake, AS_OF, HOURS).columns
        assert columns == [c for c in check.contract.columns if c != "notes"]
        assert len(columns) == count
