"""The result tables: five finding histories and the table-freshness state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.sinks.contract import Contract, Field

DEFAULT_THRESHOLD_HOURS = 168

_CHECK_TIME = Field("check_time", "timestamp", required=True, default=F.current_timestamp)


def _text(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "string") for n in names)


def _short(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "string", max_length=255) for n in names)


def _of(kind: str, *names: str) -> tuple[Field, ...]:
    return tuple(Field(n, kind) for n in names)


def _history(name: str, *columns: tuple[Field, ...]) -> Contract:
    """A finding history: run columns, the check's own, then the finding."""
    return Contract(
        name,
        (
            _CHECK_TIME,
            Field("check_threshold_hours", "int", required=True, default=lambda: F.lit(DEFAULT_THRESHOLD_HOURS)),
            *[field for group in columns for field in group],
            Field("data_age_hours", "decimal(10,2)"),
            Field("finding_type", "string", required=True, max_length=20),
            Field("notes", "string"),
        ),
    )


_MOST_RECENT = (Field("most_recent_source", "string", max_length=10), Field("most_recent_observed", "timestamp"))

_HOST = (
    *_of("bigint", "netbox_device_id"),
    Field("netbox_device_name", "string", required=True),
    *_text(
        "netbox_site_name",
        "netbox_location_name",
        "netbox_rack_name",
        "netbox_status_value",
        "netbox_serial",
        "netbox_device_type_name",
        "netbox_manufacturer_name",
        "netbox_device_role_name",
        "netbox_tenant_name",
        "netbox_primary_ip_address",
        "netbox_tags1_display",
        "netbox_total_cores",
        "netbox_total_ram",
        "netbox_cpu",
    ),
)

_NUTANIX_HOST = (
    *_of("timestamp", "nutanix_last_observed"),
    *_text("nutanix_status", "nutanix_status_description"),
    *_short("nutanix_component_moid", "nutanix_uuid"),
    *_text("nutanix_name"),
    *_short("nutanix_serial"),
    *_text("nutanix_model"),
)

MONITORING_VM = _history(
    "monitoring_vm",
    (
        *_of("bigint", "netbox_vm_id"),
        Field("netbox_vm_name", "string", required=True),
        *_text(
            "netbox_site_name",
            "netbox_cluster_name",
            "netbox_status_value",
            "netbox_custom_fields_uuid",
            "netbox_custom_fields_moid",
        ),
        *_of("bigint", "netbox_vcpus", "netbox_memory", "netbox_disk"),
    ),
    (
        *_of("timestamp", "nutanix_last_observed"),
        *_text("nutanix_status", "nutanix_status_description"),
        *_short("nutanix_component_moid", "nutanix_uuid", "nutanix_guest_os"),
        *_of("bigint", "nutanix_memory_mb"),
        *_of("int", "nutanix_num_vcpus"),
    ),
)

MONITORING_VMWARE_VM = _history(
    "monitoring_vmware_vm",
    (
        *_of("bigint", "netbox_vm_id"),
        Field("netbox_vm_name", "string", required=True),
        *_text(
            "netbox_site_name",
            "netbox_cluster_name",
            "netbox_status_value",
            "netbox_custom_fields_moid",
            "netbox_custom_fields_uuid",
        ),
        *_of("decimal(38,6)", "netbox_vcpus", "netbox_memory", "netbox_disk"),
        *_text("netbox_guest_os", "netbox_musteri", "netbox_endpoint"),
    ),
    (
        *_of("timestamp", "vmware_last_observed"),
        *_text("vmware_status", "vmware_status_description"),
        *_short("vmware_component_moid", "vmware_vcenter_uuid"),
        *_text("vmware_name", "vmware_guest_os", "vmware_tools_status"),
    ),
)

MONITORING_NUTANIX_HOST = _history(
    "monitoring_nutanix_host",
    _HOST,
    _NUTANIX_HOST,
    (
        *_of("timestamp", "vmware_last_observed"),
        *_text("vmware_status", "vmware_status_description"),
        *_short("vmware_component_moid"),
        *_text("vmware_name", "vmware_model", "vmware_version"),
    ),
    _MOST_RECENT,
)

MONITORING_VMWARE_HOST = _history(
    "monitoring_vmware_host",
    _HOST,
    (
        *_of("timestamp", "vmware_last_observed"),
        *_text("vmware_status", "vmware_status_description"),
        *_short("vmware_component_moid", "vmware_vcenter_uuid"),
        *_text("vmware_name", "vmware_model", "vmware_version"),
    ),
    _NUTANIX_HOST,
    _MOST_RECENT,
)

MONITORING_CLUSTERS = _history(
    "monitoring_clusters",
    (
        *_of("int", "netbox_cluster_id"),
        Field("netbox_cluster_name", "string", required=True),
        *_text("netbox_cluster_type", "netbox_cluster_type_slug"),
    ),
    (
        *_of("timestamp", "nutanix_last_observed"),
        *_text("nutanix_status", "nutanix_status_description"),
        *_short("nutanix_component_moid", "nutanix_uuid"),
        *_text("nutanix_name"),
    ),
    (
        *_of("timestamp", "vmware_last_observed"),
        *_text("vmware_status", "vmware_status_description"),
        *_short("vmware_component_moid"),
        *_text("vmware_name"),
    ),
    _MOST_RECENT,
)

TABLE_MONITORING = Contract(
    "table_monitoring",
    (
        Field("table_name", "string", required=True),
        Field("column_name", "string", required=True),
        Field("zabbix_host", "string", required=True),
        Field("zabbix_item_id", "string"),
        Field("zabbix_item_name", "string"),
        Field("last_data_timestamp", "timestamp"),
        Field("data_age_hours", "decimal(10,2)"),
        _CHECK_TIME,
        Field("last_clock", "bigint"),
    ),
    unique=("table_name", "column_name"),
)
