"""Stand-in inputs derived from the test tables.

The test tables hold no inventories, so each source table of the checks is
derived from ``orders``, ``customer`` or ``events`` by a query both engines
understand.  ``{name}`` marks a test table.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources.responses import HOST_RESPONSE_SCHEMA, ITEM_RESPONSE_SCHEMA
from tidemark.sources.tables import Lake, parquet

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
SINGLE_HOURS = 24
DUAL_HOURS = 48
TENANT = "Virtualization"

TEST_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

_USER_NAME = "'Customer#' || lpad(cast(user_id as string), 9, '0')"

STANDINS = {
    # A change log of machines: repeated keys, unknown update times, odd tags,
    # blank and missing keys, a status to exclude and an unknown one.
    "netbox_vm": """
        select o_orderkey as id,
               'vm-' || cast(o_orderkey as string) as name,
               'site-' || cast(o_custkey % 7 as string) as site_name,
               'cluster-' || cast(o_custkey % 31 as string) as cluster_name,
               case when o_orderstatus = 'F' then 'poweredOff'
                    when o_orderstatus = 'O' then 'poweredOn'
                    when o_orderkey % 2 = 0 then 'suspended' end as status_value,
               case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then ''
                    else cast(o_custkey as string) end as custom_fields_uuid,
               case when o_orderkey % 83 = 0 then null when o_orderkey % 79 = 0 then ''
                    else 'vm-' || cast(o_custkey as string) end as custom_fields_moid,
               cast(o_custkey % 16 + 1 as bigint) as vcpus,
               cast(o_custkey % 64 * 1024 as bigint) as memory,
               cast(o_orderkey % 500 as bigint) as disk,
               case when o_custkey % 3 = 0 then 'linux' else 'windows' end as custom_fields_guest_os,
               'owner-' || cast(o_custkey % 11 as string) as custom_fields_musteri,
               'endpoint-' || cast(o_custkey % 13 as string) as custom_fields_endpoint,
               case when o_orderpriority like '%HIGH%' then 'prod, Nutanix Acropolis'
                    when o_orderpriority like '%MEDIUM%' then 'VMware vSphere'
                    when o_orderpriority like '%NOT SPEC%' then 'VMware, Nutanix Acropolis'
                    when o_orderpriority like '%URGENT%' then 'nutanix acropolis, vmware' end as tags1_display,
               case when o_orderkey % 53 = 0 then null else o_orderdate end as last_updated
        from {orders}""",
    # Unique key, some times unknown.
    "nutanix_vm": """
        select cast(user_id as string) as component_moid,
               case when user_id % 23 = 5 then null else max(ts) end as last_observed,
               min(event_type) as status,
               'Power:' || max(event_type) as status_description,
               'nx-' || cast(user_id as string) as nutanix_uuid,
               case when user_id % 3 = 0 then 'linux' end as guest_os,
               cast(count(*) as bigint) as memory_mb,
               cast(user_id % 8 as int) as num_vcpus
        from {events} group by user_id""",
    # Repeated key: a record fans out.
    "vmware_vm": """
        select 'vm-' || cast(user_id as string) as component_moid,
               case when event_id % 41 = 0 then null else ts end as last_observed,
               case when event_id % 2 = 0 then 'green' else 'red' end as status,
               'event ' || cast(event_id as string) as status_description,
               'vc-' || cast(user_id % 4 as string) as vcenter_uuid,
               'vm ' || cast(user_id as string) as name,
               case when user_id % 3 = 0 then 'linux' end as guest_os,
               case when event_id % 3 = 0 then 'running' end as tools_status
        from {events} where event_type = 'view'""",
    # A change log of devices; one name shared by many of them.
    "netbox_device": """
        select o_custkey as id,
               case when o_custkey % 37 = 0 then 'localhost'
                    else 'Customer#' || lpad(cast(o_custkey as string), 9, '0') end as name,
               'site-' || cast(o_custkey % 7 as string) as site_name,
               'room-' || cast(o_custkey % 5 as string) as location_name,
               'rack-' || cast(o_custkey % 9 as string) as rack_name,
               o_orderstatus as status_value,
               case when o_custkey % 41 = 0 then null when o_custkey % 43 = 0 then ''
                    else cast(o_custkey as string) end as serial,
               'type-' || cast(o_custkey % 3 as string) as device_type_name,
               'maker-' || cast(o_custkey % 4 as string) as manufacturer_name,
               'hypervisor' as device_role_name,
               case when o_custkey % 5 = 0 then 'Other' else 'Virtualization' end as tenant_name,
               '10.0.0.' || cast(o_custkey % 250 as string) as primary_ip_address,
               case when o_orderpriority like '%URGENT%' then 'ESXI NUTANIX'
                    when o_orderpriority like '%HIGH%' then 'ESXI KLASIK HOST'
                    when o_orderpriority like '%MEDIUM%' then 'HYPER-V'
                    when o_orderpriority like '%NOT SPEC%' then 'esxi nutanix' end as tags1_display,
               cast(o_custkey % 64 as string) as total_cores,
               cast(o_orderkey % 512 as string) as total_ram,
               'cpu-' || cast(o_orderkey % 6 as string) as cpu,
               o_orderdate + cast(o_orderkey % 86400 as int) * interval '1' second as last_updated
        from {orders}""",
    "nutanix_host": """
        select 'nx-host-' || cast(user_id as string) as name,
               case when user_id % 10 = 3 then null else ts end as last_observed,
               case when event_id % 2 = 0 then 'OK' else 'WARN' end as status,
               'event ' || cast(event_id as string) as status_description,
               lpad(cast(event_id as string), 12, '0') as component_moid,
               'nx-' || cast(event_id % 6 as string) as nutanix_uuid,
               case when user_id % 11 = 0 then '' else cast(user_id as string) end as serial,
               'model-' || cast(user_id % 5 as string) as model
        from {events} where event_type = 'click'""",
    "vmware_host": f"""
        select case when user_id % 3 = 0 then 'unlisted-' || cast(user_id as string)
                    when user_id % 13 = 5 then null else {_USER_NAME} end as name,
               ts as last_observed,
               case when event_id % 2 = 0 then 'green' else 'red' end as status,
               'event ' || cast(event_id as string) as status_description,
               lpad(cast(event_id as string), 12, '0') as component_moid,
               'vc-' || cast(user_id % 4 as string) as vcenter_uuid,
               'model-' || cast(user_id % 6 as string) as model,
               '8.0.' || cast(user_id % 3 as string) as version
        from {{events}} where event_type = 'purchase'""",
    "nutanix_cluster": f"""
        select {_USER_NAME} as name,
               case when user_id % 10 = 3 then null else ts end as last_observed,
               case when event_id % 2 = 0 then 'OK' else 'WARN' end as status,
               'event ' || cast(event_id as string) as status_description,
               lpad(cast(event_id as string), 12, '0') as component_moid,
               'nx-' || cast(event_id % 6 as string) as nutanix_uuid
        from {{events}} where event_type = 'signup'""",
    "vmware_cluster": f"""
        select case when user_id % 4 = 0 then 'unlisted-' || cast(user_id as string)
                    when user_id % 13 = 5 then null else {_USER_NAME} end as name,
               ts as last_observed,
               case when event_id % 2 = 0 then 'green' else 'red' end as status,
               'event ' || cast(event_id as string) as status_description,
               lpad(cast(event_id as string), 12, '0') as component_moid
        from {{events}} where event_type = 'error'""",
    # Records of the paged inventory, before they become JSON pages.
    "cluster_record": """
        select cast(c_custkey as int) as id,
               case when c_custkey % 17 = 0 then '' when c_custkey % 19 = 0 then null
                    when c_custkey % 40 = 7 then 'Customer#' || lpad(cast(c_custkey - 1 as string), 9, '0')
                    else c_name end as display,
               c_name as name,
               case when c_custkey % 29 <> 0 then c_mktsegment end as type_display,
               case when c_custkey % 29 = 0 then null
                    when c_custkey % 3 = 0 then 'vmware-cls' else 'acropolis-cls' end as type_slug
        from {customer}""",
    # Monitoring items, before they become JSON responses.  The value's format
    # goes by event_id % 18; some names, values and clocks do not parse.
    "item": """
        select event_id,
               cast(event_id as string) as itemid,
               case when event_id % 31 = 0 then 'Table [' || event_type || '] Last data timestamp (ts)'
                    when event_id % 37 = 0 then 'Table [ ]: Last data timestamp (ts)'
                    when event_id % 29 = 0
                    then ' table  [ ' || event_type || '_' || cast(user_id as string) || ' ]:  LAST data  timestamp (ts) '
                    when event_id % 27 = 0
                    then 'Table [' || event_type || '_' || cast(user_id as string) || ']: Last data timestamp ( )'
                    else 'Table [' || event_type || '_' || cast(user_id as string) || ']: Last data timestamp (ts)'
                    end as name,
               case cast(event_id % 18 as int)
                    when 0 then cast(1704067200 + (day(ts) - 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60
                                     + cast(second(ts) as int) as string)
                    when 1 then d || ' ' || h24 || ':' || m || ':' || s
                    when 2 then d || ' ' || h12 || ':' || m || ':' || s || ' ' || ampm
                    when 3 then d || 'T' || h24 || ':' || m || ':' || s || '.250Z'
                    when 4 then us || ' ' || h12 || ':' || m || ':' || s || ' ' || lower(ampm)
                    when 5 then d
                    when 6 then cast(year(ts) as string) || '-' || cast(month(ts) as string) || '-'
                                || cast(day(ts) as string) || ' ' || cast(hour(ts) as string) || ':'
                                || cast(minute(ts) as string)
                    when 7 then d || ' ' || h24 || ':' || m || ':' || s || '+03:00'
                    when 8 then case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'garbage' end
                    when 10 then d || ' ' || h24 || ':' || m || ':' || s || '+03'
                    when 11 then d || 'T' || h24 || ':' || m || ':' || s || '+0300'
                    when 12 then d || 'T' || h24 || ':' || m || ':' || s || '.1234567Z'
                    when 13 then d || ' ' || h24 || ':' || m || ':' || s || ',123456789'
                    when 14 then d || 'T' || h24
                    when 15 then replace(d, '-', '') || 'T' || h24 || m || s
                    when 16 then d || ' ' || h24 || ':' || m || ':' || s || ' +03:00'
                    when 17 then '2024-W' || lpad(cast(cast(floor((day(ts) - 1) / 7) as int) + 1 as string), 2, '0')
                                 || '-' || cast((day(ts) - 1) % 7 + 1 as string)
                    else ' ' || d || '  13:' || m || ':' || s || ' AM ' end as lastvalue,
               case when event_id % 23 = 0 then 'abc' when event_id % 19 = 0 then ''
                    when event_id % 17 = 0 then null
                    else cast(1704067200 + event_id as string) end as lastclock,
               case when event_id % 7 = 0 then '2' else '1' end as hostid,
               case when event_id % 5 <> 2 then 'last data' else 'other' end as tag
        from (select *,
                     cast(year(ts) as string) || '-' || lpad(cast(month(ts) as string), 2, '0') || '-'
                         || lpad(cast(day(ts) as string), 2, '0') as d,
                     lpad(cast(month(ts) as string), 2, '0') || '/' || lpad(cast(day(ts) as string), 2, '0') || '/'
                         || cast(year(ts) as string) as us,
                     lpad(cast(hour(ts) as string), 2, '0') as h24,
                     lpad(cast(case when hour(ts) % 12 = 0 then 12 else hour(ts) % 12 end as string), 2, '0') as h12,
                     case when hour(ts) < 12 then 'AM' else 'PM' end as ampm,
                     lpad(cast(minute(ts) as string), 2, '0') as m,
                     lpad(cast(cast(second(ts) as int) as string), 2, '0') as s
              from {events}) e""",
    "monitored_host": """
        select cast(n_nationkey as string) as hostid,
               case when n_nationkey = 1 then 'db-master' else lower(n_name) end as host
        from {nation}""",
    # A finding history with one check per day.
    "history": """
        select event_id,
               cast(cast(ts as date) as timestamp) as check_time,
               'record-' || cast(user_id as string) as netbox_vm_name,
               case when event_type = 'error' then null else ts end as nutanix_last_observed,
               case when event_type = 'error' then null else value end as data_age_hours,
               'cluster-' || cast(user_id % 31 as string) as netbox_cluster_name,
               case when event_type = 'error' then 'MISSING' else 'STALE' end as finding_type
        from {events}""",
}

RECORDS_PER_PAGE = 50
ITEMS_PER_RESPONSE = 100


def source_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The test tables themselves."""
    return Lake(spark, {t: parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TEST_TABLES})


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lake = source_lake(spark, sf_dir)
    text = STANDINS[name]
    used = {t: lake.table(t) for t in TEST_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def standin_lake(spark: SparkSession, sf_dir: str, *names: str) -> Lake:
    return Lake(spark, {n: standin(spark, sf_dir, n) for n in names})


def land_cluster_pages(spark: SparkSession, sf_dir: str) -> str:
    """Write the cluster inventory as JSON pages of 50, one page per line."""
    record = F.struct(
        "id",
        "display",
        "name",
        F.when(F.col("type_slug").isNotNull(), F.struct(F.col("type_display").alias("display"), F.col("type_slug").alias("slug"))).alias("type"),
    )
    records = standin(spark, sf_dir, "cluster_record")
    total = records.agg(F.count(F.lit(1)).alias("n")).scalar()
    address = F.concat(F.lit("/clusters?page="), F.col("page").cast("string"))
    following = F.concat(F.lit("/clusters?page="), (F.col("page") + 1).cast("string"))
    pages = (
        records
        .withColumn("page", F.floor((F.col("id") - 1) / RECORDS_PER_PAGE))
        .groupBy("page")
        .agg(F.collect_list(record).alias("results"))
        .select(
            address.alias("url"),
            F.when((F.col("page") + 1) * RECORDS_PER_PAGE < total, following).alias("next"),
            total.alias("count"),
            "results",
        )
    )
    location = scratch_dir(spark, "pages")
    pages.write.json(location)
    return location


def item_responses(spark: SparkSession, sf_dir: str, errors: bool = False) -> DataFrame:
    """Item responses of 100 items each; with ``errors``, every 25th one failed."""
    tag = F.struct(F.col("tag"))
    item = F.struct("itemid", "name", "lastvalue", "lastclock", "hostid", F.array(F.struct(F.lit("env").alias("tag")), tag).alias("tags"))
    batches = (
        standin(spark, sf_dir, "item")
        .withColumn("batch", F.floor(F.col("event_id") / ITEMS_PER_RESPONSE).cast("int"))
        .groupBy("batch")
        .agg(F.collect_list(item).alias("result"))
    )
    if not errors:
        text = F.to_json(F.struct("result"))
    else:
        error = F.struct(
            (-32600 - F.col("batch")).alias("code"),
            F.lit("Invalid request.").alias("message"),
            F.concat(F.lit("batch "), F.col("batch").cast("string")).alias("data"),
        )
        text = F.when(F.col("batch") % 25 == 0, F.to_json(F.struct(error.alias("error")))).otherwise(F.to_json(F.struct("result")))
    return batches.select(F.from_json(text, ITEM_RESPONSE_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def land_item_responses(spark: SparkSession, sf_dir: str) -> str:
    location = scratch_dir(spark, "responses")
    item_responses(spark, sf_dir).write.json(location)
    return location


def host_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host responses, one host each."""
    hosts = standin(spark, sf_dir, "monitored_host").select(F.to_json(F.struct(F.array(F.struct("hostid", "host")).alias("result"))).alias("text"))
    return hosts.select(F.from_json("text", HOST_RESPONSE_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")


