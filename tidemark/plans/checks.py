"""The five inventory checks, as configurations of one pipeline.

Column maps go from source column to output column; filters are functions
because a column expression needs a running session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import filters
from tidemark.operators.filters import prefixed
from tidemark.operators.findings import NULL_IS_EPOCH, NULL_IS_MISSING, Feed
from tidemark.operators.latest import latest_per_key
from tidemark.sinks import tables
from tidemark.sinks.contract import Contract
from tidemark.sources.tables import Lake

# The tags and status the inventory filters look for.  So are the
# column maps below, which name the columns of the sources and of the result tables.
NUTANIX_VM_TAG = "Nutanix Acropolis"
VMWARE_VM_TAG = "VMware"
POWERED_OFF = "poweredOff"
NUTANIX_HOST_TAG = "ESXI NUTANIX"
VMWARE_HOST_TAGS = (
    "ESXI KLASIK HOST",
    "ESXI KLASIK SAP HOST",
    "ESXI NUTANIX",
    "ESXI NUTANIX HOST",
    "HYBRID",
    "HYPER-V",
    "KLASIK MIMARI",
)

Filter = Callable[[], Column]


@dataclass(frozen=True)
class Inventory:
    """What should be reporting.  ``key`` None keeps repeated records."""

    table: str
    columns: Mapping[str, str]
    where: Filter | None = None
    key: str | None = None
    newest: str = "last_updated"
    tiebreak: tuple[str, ...] = ("id",)

    def frame(self, lake: Lake) -> DataFrame:
        needed = list(self.columns)
        if self.key:
            needed += [self.key, self.newest, *self.tiebreak]
        rows = lake.needed(self.table, needed, self.where)
        if self.key:
            # Prune before the shuffle: an opaque source (JSON, JDBC) may not.
            rows = latest_per_key(rows.select(*dict.fromkeys(needed)), [self.key], self.newest, self.tiebreak)
        return filters.renamed(rows, self.columns)


@dataclass(frozen=True)
class Observed:
    """What did report: ``key`` is compared with the inventory output ``matches``.

    ``tiebreak`` settles equal times of one key, where only its latest row counts.
    """

    label: str
    table: str
    columns: Mapping[str, str]
    key: str
    matches: str
    where: Filter | None = None
    observed_at: str = "last_observed"
    tiebreak: tuple[str, ...] = ("component_moid",)

    def feed(self, lake: Lake) -> Feed:
        rows = lake.needed(self.table, [*self.columns, *self.tiebreak], self.where)
        return Feed(
            self.label,
            filters.renamed(rows, self.columns),
            self.columns[self.key],
            self.columns[self.observed_at],
            self.matches,
            tuple(self.columns[c] for c in self.tiebreak),
        )


@dataclass(frozen=True)
class Check:
    """One check: inventory, one or two sources, and where findings go.

    ``row_id`` is the inventory output column that settles ties in finding order.
    """

    inventory: Inventory
    sources: tuple[Observed, ...]
    contract: Contract
    row_id: str
    preview: Mapping[str, str]
    null_policy: str | None = None


# --- virtual machines -------------------------------------------------------

NUTANIX_VM = Check(
    inventory=Inventory(
        table="netbox_vm",
        where=lambda: filters.tag_contains("tags1_display", NUTANIX_VM_TAG)
        & F.col("custom_fields_uuid").isNotNull()
        & filters.status_is_not("status_value", POWERED_OFF),
        key="custom_fields_uuid",
        columns={
            **prefixed("netbox_vm_", "id", "name"),
            **prefixed(
                "netbox_",
                "site_name",
                "cluster_name",
                "status_value",
                "custom_fields_uuid",
                "custom_fields_moid",
                "vcpus",
                "memory",
                "disk",
            ),
        },
    ),
    sources=(
        Observed(
            label="NUTANIX",
            table="nutanix_vm",
            key="component_moid",
            matches="netbox_custom_fields_uuid",
            columns={
                **prefixed("nutanix_", "last_observed", "status", "status_description", "component_moid"),
                "nutanix_uuid": "nutanix_uuid",
                **prefixed("nutanix_", "guest_os", "memory_mb", "num_vcpus"),
            },
        ),
    ),
    contract=tables.MONITORING_VM,
    row_id="netbox_vm_id",
    preview={
        "netbox_vm_name": "name",
        "netbox_site_name": "site",
        "netbox_cluster_name": "cluster",
        "netbox_status_value": "status",
        "nutanix_last_observed": "last_observed",
    },
)

VMWARE_VM = Check(
    inventory=Inventory(
        table="netbox_vm",
        where=lambda: filters.tag_contains("tags1_display", VMWARE_VM_TAG)
        & filters.not_blank("custom_fields_moid")
        & filters.status_is_not("status_value", POWERED_OFF),
        key="custom_fields_moid",
        columns={
            **prefixed("netbox_vm_", "id", "name"),
            **prefixed(
                "netbox_",
                "site_name",
                "cluster_name",
                "status_value",
                "custom_fields_moid",
                "custom_fields_uuid",
                "vcpus",
                "memory",
                "disk",
            ),
            "custom_fields_guest_os": "netbox_guest_os",
            "custom_fields_musteri": "netbox_musteri",
            "custom_fields_endpoint": "netbox_endpoint",
        },
    ),
    sources=(
        Observed(
            label="VMWARE",
            table="vmware_vm",
            key="component_moid",
            matches="netbox_custom_fields_moid",
            columns=prefixed(
                "vmware_",
                "last_observed",
                "status",
                "status_description",
                "component_moid",
                "vcenter_uuid",
                "name",
                "guest_os",
                "tools_status",
            ),
        ),
    ),
    contract=tables.MONITORING_VMWARE_VM,
    row_id="netbox_vm_id",
    preview={
        "netbox_vm_name": "name",
        "netbox_custom_fields_moid": "moid",
        "netbox_musteri": "customer",
        "vmware_last_observed": "last_observed",
    },
)

# --- hosts ------------------------------------------------------------------

_HOST_COLUMNS = {
    **prefixed("netbox_device_", "id", "name"),
    **prefixed(
        "netbox_",
        "site_name",
        "location_name",
        "rack_name",
        "status_value",
        "serial",
        "device_type_name",
        "manufacturer_name",
        "device_role_name",
        "tenant_name",
        "primary_ip_address",
        "tags1_display",
        "total_cores",
        "total_ram",
        "cpu",
    ),
}

_NUTANIX_HOSTS = Observed(
    label="NUTANIX",
    table="nutanix_host",
    where=lambda: filters.not_blank("serial"),
    key="serial",
    matches="netbox_serial",
    columns={
        **prefixed("nutanix_", "last_observed", "status", "status_description", "component_moid"),
        "nutanix_uuid": "nutanix_uuid",
        **prefixed("nutanix_", "name", "serial", "model"),
    },
)


def _vmware_hosts(*extra: str) -> Observed:
    """Hosts by name.  NULL names form one group that matches nothing."""
    return Observed(
        label="VMWARE",
        table="vmware_host",
        key="name",
        matches="netbox_device_name",
        columns=prefixed(
            "vmware_", "last_observed", "status", "status_description", "component_moid", *extra, "name", "model", "version"
        ),
    )


_HOST_PREVIEW = {
    "netbox_device_name": "name",
    "netbox_serial": "serial",
    "netbox_site_name": "site",
    "most_recent_source": "source",
    "most_recent_observed": "last_observed",
}


def nutanix_host(tenant: str) -> Check:
    """Hosts with the Nutanix tag, one per serial; Nutanix wins a tie."""
    return Check(
        inventory=Inventory(
            table="netbox_device",
            where=lambda: (F.col("tags1_display") == NUTANIX_HOST_TAG)
            & (F.col("tenant_name") == tenant)
            & filters.not_blank("serial"),
            key="serial",
            columns=_HOST_COLUMNS,
        ),
        sources=(_NUTANIX_HOSTS, _vmware_hosts()),
        contract=tables.MONITORING_NUTANIX_HOST,
        row_id="netbox_device_id",
        preview=_HOST_PREVIEW,
        null_policy=NULL_IS_EPOCH,
    )


def vmware_host(tenant: str) -> Check:
    """Hosts with any accepted tag, one per id, serial or not; VMware wins a tie."""
    return Check(
        inventory=Inventory(
            table="netbox_device",
            where=lambda: filters.tag_in("tags1_display", VMWARE_HOST_TAGS) & (F.col("tenant_name") == tenant),
            key="id",
            tiebreak=("name", "serial"),
            columns=_HOST_COLUMNS,
        ),
        sources=(_vmware_hosts("vcenter_uuid"), _NUTANIX_HOSTS),
        contract=tables.MONITORING_VMWARE_HOST,
        row_id="netbox_device_id",
        preview={"netbox_tags1_display": "tag", **_HOST_PREVIEW},
        null_policy=NULL_IS_EPOCH,
    )


# --- clusters ---------------------------------------------------------------

CLUSTER = Check(
    inventory=Inventory(
        table="netbox_cluster",
        columns={
            "id": "netbox_cluster_id",
            "name": "netbox_cluster_name",
            "type_display": "netbox_cluster_type",
            "type_slug": "netbox_cluster_type_slug",
        },
    ),
    sources=(
        Observed(
            label="NUTANIX",
            table="nutanix_cluster",
            key="name",
            matches="netbox_cluster_name",
            columns={
                **prefixed("nutanix_", "last_observed", "status", "status_description", "component_moid"),
                "nutanix_uuid": "nutanix_uuid",
                "name": "nutanix_name",
            },
        ),
        Observed(
            label="VMWARE",
            table="vmware_cluster",
            key="name",
            matches="netbox_cluster_name",
            columns=prefixed("vmware_", "last_observed", "status", "status_description", "component_moid", "name"),
        ),
    ),
    contract=tables.MONITORING_CLUSTERS,
    row_id="netbox_cluster_id",
    preview={
        "netbox_cluster_name": "name",
        "netbox_cluster_type": "type",
        "most_recent_source": "source",
        "most_recent_observed": "last_observed",
    },
    null_policy=NULL_IS_MISSING,
)
