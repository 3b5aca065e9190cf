"""Small hand-made source tables in the shape the checks read."""

from __future__ import annotations

VM_SCHEMA = (
    "id long, name string, site_name string, cluster_name string, status_value string, custom_fields_uuid string, "
    "custom_fields_moid string, vcpus decimal(10,2), memory decimal(10,2), disk decimal(10,2), custom_fields_guest_os string, "
    "custom_fields_musteri string, custom_fields_endpoint string, tags1_display string, last_updated timestamp"
)
DEVICE_SCHEMA = (
    "id long, name string, site_name string, location_name string, rack_name string, status_value string, serial string, "
    "device_type_name string, manufacturer_name string, device_role_name string, tenant_name string, "
    "primary_ip_address string, tags1_display string, total_cores string, total_ram string, cpu string, last_updated timestamp"
)
OBSERVED_SCHEMAS = {
    "nutanix_vm": "component_moid string, last_observed timestamp, status string, status_description string, "
    "nutanix_uuid string, guest_os string, memory_mb long, num_vcpus int",
    "vmware_vm": "component_moid string, last_observed timestamp, status string, status_description string, "
    "vcenter_uuid string, name string, guest_os string, tools_status string",
    "nutanix_host": "name string, last_observed timestamp, status string, status_description string, "
    "component_moid string, nutanix_uuid string, serial string, model string",
    "vmware_host": "name string, last_observed timestamp, status string, status_description string, "
    "component_moid string, vcenter_uuid string, model string, version string",
    "nutanix_cluster": "name string, last_observed timestamp, status string, status_description string, "
    "component_moid string, nutanix_uuid string",
    "vmware_cluster": "name string, last_observed timestamp, status string, status_description string, component_moid string",
}
CLUSTER_SCHEMA = "id int, name string, type_display string, type_slug string"


def table(spark, schema: str, rows: list[dict]):
    """A table with the given columns set and all others NULL."""
    names = [part.split()[0] for part in schema.replace("(10,2)", "").split(", ")]
    assert all(set(r) <= set(names) for r in rows)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def machines(spark, rows: list[dict], **defaults):
    return table(spark, VM_SCHEMA, [{"name": f"vm{r.get('id')}", "status_value": "poweredOn", **defaults, **r} for r in rows])


def devices(spark, rows: list[dict], **defaults):
    return table(spark, DEVICE_SCHEMA, [{**defaults, **r} for r in rows])


def observed(spark, name: str, rows: list[dict]):
    return table(spark, OBSERVED_SCHEMAS[name], rows)


def clusters(spark, rows: list[dict]):
    return table(spark, CLUSTER_SCHEMA, rows)
