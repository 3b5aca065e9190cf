"""The same queries in DuckDB's SQL, over the same tables."""

from __future__ import annotations

from workload.standins import STANDINS, TEST_TABLES

AS_OF = "timestamp '2024-01-31 00:00:00'"
EPOCH = "timestamp '1970-01-01 00:00:00'"
SINGLE_LIMIT = f"({AS_OF} - interval 24 hour)"
DUAL_LIMIT = f"({AS_OF} - interval 48 hour)"
ITEM_NAME = r"^Table\s+\[(.+?)\]:\s+Last\s+data\s+timestamp\s+\((.+?)\)$"
BLANKS = "' '"


def standin(name: str) -> str:
    return STANDINS[name].format(**{t: t for t in TEST_TABLES})


def with_standins(*names: str) -> str:
    return "with " + ", ".join(f"{n} as ({standin(n)})" for n in names)


def age(ts: str) -> str:
    """Hours, exact, half up (ages here are not negative)."""
    return f"cast((epoch_us({AS_OF}) - epoch_us({ts}) + 18000000) // 36000000 as double) / 100"


def float_age(ts: str) -> str:
    return f"cast(printf('%.2f', (epoch_us({AS_OF}) - epoch_us({ts})) / 1000000.0 / 3600.0) as double)"


def days_label(age_column: str) -> str:
    return f"case when {age_column} is null or {age_column} = 0 then '?' else printf('%.1f', {age_column} / 24.0) end"


def latest(table: str, key: str, newest: str, *tiebreak: str, where: str = "true") -> str:
    order = ", ".join([f"{newest} desc nulls last", *tiebreak])
    return f"select distinct on ({key}) * from {table} where {where} order by {key}, {order}"


# --- findings, from the rules ------------------------------------------------
#
# A record with no observation is MISSING: ``not exists``.  One observation of a
# single source, or the newest of several sources, is STALE if it is before the
# limit.  Sightings of all sources are one list of (record, source, time); a lower
# rank wins among equal times.


def single(inventory: str, key: str, source: str, match: str, limit: str, columns: dict[str, str]) -> str:
    """Rows of ``inventory`` and ``columns`` of each stale row of ``source``, or the label MISSING."""
    named = ", ".join(f"s.{c} as {name}" for c, name in columns.items())
    return f"""
  select i.*, {named}, {age("s.last_observed")} as data_age_hours, 'STALE' as finding_type
  from {inventory} i, {source} s where s.{match} = i.{key} and s.last_observed < {limit}
  union all by name
  select i.*, 'MISSING' as finding_type from {inventory} i
  where not exists (from {source} s where s.{match} = i.{key})"""


def sightings(record: str, sources: list[tuple[str, str, str, str]]) -> str:
    """(record, source, seen_at, rank) from (label, relation, time column, join condition), best rank first."""
    return " union all ".join(
        f"select i.{record} as record, '{label}' as source, s.{time} as seen_at, {rank} as rank from inv i join {relation} s on {on}"
        for rank, (label, relation, time, on) in enumerate(sources)
    )


NEWEST = f"""
  select record, max(seen_at) as most_recent_observed, max(coalesce(seen_at, {EPOCH})) as last_sign,
         arg_max(source, epoch_us(seen_at) * 10 - rank) filter (seen_at is not null) as most_recent_source
  from sightings group by record"""

# Labels by what a sighting without a time means.
LABEL_EPOCH = f"case when n.record is null then 'MISSING' when last_sign < {DUAL_LIMIT} then 'STALE' end"
LABEL_NULLSAFE = f"case when most_recent_observed is null then 'MISSING' when most_recent_observed < {DUAL_LIMIT} then 'STALE' end"
AGE_EPOCH = age(f"coalesce(last_sign, {EPOCH})")
AGE_NULLSAFE = float_age("most_recent_observed")


def dual(record: str, columns: str, joins: str, label: str, hours: str) -> str:
    """Findings of ``inv`` over ``sightings``: ``columns`` are of i (inventory) and the joined sources."""
    return f"""newest as ({NEWEST}),
labelled as (
  select {columns}, most_recent_source, most_recent_observed, {hours} as data_age_hours, {label} as finding_type
  from inv i left join newest n on n.record = i.{record} {joins})"""


INVENTORY = latest("orders", "o_custkey", "o_orderdate", "o_orderkey",
                   where="o_orderpriority like '%I%' and o_orderstatus != 'F'")
EVENT_COLUMNS = {"user_id": "obs_key", "event_id": "event_id", "last_observed": "last_observed"}
SINGLE = f"""
with inv as (select o_custkey as inv_id, o_orderkey as inv_ref from ({INVENTORY}) x),
seen as (select user_id, event_id, ts as last_observed from events),
findings as ({single("inv", "inv_id", "seen", "user_id", SINGLE_LIMIT, EVENT_COLUMNS)})
"""

_DUAL = f"""
with inv as (select c_custkey as inv_id, c_name as inv_name from customer),
a_rows as (select user_id as a_key, case when user_id % 10 <> 3 then ts end as a_ts, event_id as a_id
           from events where event_type = 'click'),
b_rows as (select case when user_id % 3 = 0 then 'unlisted-' || cast(user_id as varchar)
                       else 'Customer#' || lpad(cast(user_id as varchar), 9, '0') end as b_key,
                  ts as b_ts, event_id as b_id
           from events where event_type = 'purchase'),
a as ({latest("a_rows", "a_key", "a_ts", "a_id")}),
b as ({latest("b_rows", "b_key", "b_ts", "b_id")}),
sightings as ({sightings("inv_id", [("A", "a", "a_ts", "s.a_key = i.inv_id"), ("B", "b", "b_ts", "s.b_key = i.inv_name")])}),
"""
_DUAL_COLUMNS = "i.inv_id, i.inv_name, a_key, a_ts, a_id, b_key, b_ts, b_id"
_DUAL_JOINS = "left join a on a_key = i.inv_id left join b on b_key = i.inv_name"
FINDINGS_ONLY = "select * from labelled where finding_type is not null"

DUAL_EPOCH = _DUAL + dual("inv_id", _DUAL_COLUMNS, _DUAL_JOINS, LABEL_EPOCH, AGE_EPOCH) + FINDINGS_ONLY
DUAL_NULLSAFE = _DUAL + dual("inv_id", _DUAL_COLUMNS, _DUAL_JOINS, LABEL_NULLSAFE, AGE_NULLSAFE) + FINDINGS_ONLY

# --- jobs over stand-ins ----------------------------------------------------


def stamp(hours: int) -> str:
    return f"{AS_OF} as check_time, cast({hours} as integer) as check_threshold_hours,"


def prefixed(prefix: str, columns: list[str]) -> str:
    return ", ".join(f"{c} as {prefix}{c}" for c in columns)


# The columns of the results, in the order of their contracts.
VM_COLUMNS = [
    "site_name", "cluster_name", "status_value", "custom_fields_uuid", "custom_fields_moid", "vcpus", "memory", "disk",
]
HOST_COLUMNS = [
    "site_name", "location_name", "rack_name", "status_value", "serial", "device_type_name", "manufacturer_name",
    "device_role_name", "tenant_name", "primary_ip_address", "tags1_display", "total_cores", "total_ram", "cpu",
]
NUTANIX_VM_COLUMNS = ["last_observed", "status", "status_description", "component_moid", "guest_os", "memory_mb", "num_vcpus"]
VMWARE_VM_COLUMNS = [
    "last_observed", "status", "status_description", "component_moid", "vcenter_uuid", "name", "guest_os", "tools_status",
]
NUTANIX_HOST_COLUMNS = ["last_observed", "status", "status_description", "component_moid", "name", "serial", "model"]
VMWARE_HOST_COLUMNS = ["last_observed", "status", "status_description", "component_moid", "name", "model", "version"]
NUTANIX_CLUSTER_COLUMNS = ["last_observed", "status", "status_description", "component_moid", "name"]
VMWARE_CLUSTER_COLUMNS = NUTANIX_CLUSTER_COLUMNS


def named(prefix: str, columns: list[str], **extra: str) -> dict[str, str]:
    return {c: prefix + c for c in columns} | extra


def machine_job(source: str, record_key: str, where: str, columns: dict[str, str], more: str = "") -> str:
    """Findings of virtual machines against one source."""
    key = f"netbox_{record_key}"
    newest = latest("netbox_vm", record_key, "last_updated", "id", where=where)
    return f"""{with_standins("netbox_vm", source)},
inv as (select id as netbox_vm_id, name as netbox_vm_name, {prefixed("netbox_", VM_COLUMNS)}{more} from ({newest}) x),
findings as ({single("inv", key, source, "component_moid", SINGLE_LIMIT, columns)})
select {stamp(24)} * from findings"""


JOB_VM_UUID = machine_job(
    "nutanix_vm", "custom_fields_uuid",
    "tags1_display like '%Nutanix Acropolis%' and custom_fields_uuid is not null and status_value != 'poweredOff'",
    named("nutanix_", NUTANIX_VM_COLUMNS, nutanix_uuid="nutanix_uuid"),
)
JOB_VM_MOID = machine_job(
    "vmware_vm", "custom_fields_moid",
    "tags1_display like '%VMware%' and length(custom_fields_moid) > 0 and status_value != 'poweredOff'",
    named("vmware_", VMWARE_VM_COLUMNS),
    ", custom_fields_guest_os as netbox_guest_os, custom_fields_musteri as netbox_musteri, "
    "custom_fields_endpoint as netbox_endpoint",
)


def source_columns(alias: str, prefix: str, columns: list[str], *plain: str) -> str:
    return ", ".join([*[f"{alias}.{c} as {prefix}{c}" for c in columns], *[f"{alias}.{c} as {name}" for c, name in
                      (p.split(" as ") if " as " in p else (p, p) for p in plain)]])


def host_job(inventory: str, order: list[str], *vmware: str) -> str:
    """Findings of hosts against both sources; ``order`` has the labels, best rank first."""
    sources = {
        "NUTANIX": ("NUTANIX", "nx", "last_observed", "s.serial = i.netbox_serial"),
        "VMWARE": ("VMWARE", "vm", "last_observed", "s.name = i.netbox_device_name"),
    }
    columns = ", ".join(
        [
            "i.*",
            source_columns("nx", "nutanix_", NUTANIX_HOST_COLUMNS, "nutanix_uuid"),
            source_columns("vm", "vmware_", VMWARE_HOST_COLUMNS, *vmware),
        ]
    )
    joins = "left join nx on nx.serial = i.netbox_serial left join vm on vm.name = i.netbox_device_name"
    return f"""{with_standins("netbox_device", "nutanix_host", "vmware_host")},
inv as (select id as netbox_device_id, name as netbox_device_name, {prefixed("netbox_", HOST_COLUMNS)} from ({inventory}) x),
nx as ({latest("nutanix_host", "serial", "last_observed", "component_moid", where="length(serial) > 0")}),
vm as ({latest("vmware_host", "name", "last_observed", "component_moid")}),
sightings as ({sightings("netbox_device_id", [sources[label] for label in order])}),
{dual("netbox_device_id", columns, joins, LABEL_EPOCH, AGE_EPOCH)}
select {stamp(48)} * from labelled where finding_type is not null"""


JOB_HOST_SERIAL_FIRST = host_job(
    latest("netbox_device", "serial", "last_updated", "id",
           where="tags1_display = 'ESXI NUTANIX' and tenant_name = 'Virtualization' and length(serial) > 0"),
    ["NUTANIX", "VMWARE"],
)
JOB_HOST_NAME_FIRST = host_job(
    latest("netbox_device", "id", "last_updated",
           where="tags1_display in ('ESXI KLASIK HOST', 'ESXI KLASIK SAP HOST', 'ESXI NUTANIX', 'ESXI NUTANIX HOST', "
                 "'HYBRID', 'HYPER-V', 'KLASIK MIMARI') and tenant_name = 'Virtualization'"),
    ["VMWARE", "NUTANIX"], "vcenter_uuid as vmware_vcenter_uuid",
)

CLUSTERS = "select id, coalesce(nullif(display, ''), name) as name, type_display, type_slug from cluster_record"

_CLUSTER_COLUMNS = ", ".join(
    [
        "i.*",
        source_columns("nx", "nutanix_", NUTANIX_CLUSTER_COLUMNS, "nutanix_uuid"),
        source_columns("vm", "vmware_", VMWARE_CLUSTER_COLUMNS),
    ]
)
_CLUSTER_SOURCES = [
    ("NUTANIX", "nx", "last_observed", "s.name = i.netbox_cluster_name"),
    ("VMWARE", "vm", "last_observed", "s.name = i.netbox_cluster_name"),
]
_CLUSTER_JOINS = "left join nx on nx.name = i.netbox_cluster_name left join vm on vm.name = i.netbox_cluster_name"
JOB_CLUSTER = f"""{with_standins("cluster_record", "nutanix_cluster", "vmware_cluster")},
inv as (select id as netbox_cluster_id, name as netbox_cluster_name, type_display as netbox_cluster_type,
               type_slug as netbox_cluster_type_slug from ({CLUSTERS} where type_slug = 'acropolis-cls') x),
nx as ({latest("nutanix_cluster", "name", "last_observed", "component_moid")}),
vm as ({latest("vmware_cluster", "name", "last_observed", "component_moid")}),
sightings as ({sightings("netbox_cluster_id", _CLUSTER_SOURCES)}),
{dual("netbox_cluster_id", _CLUSTER_COLUMNS, _CLUSTER_JOINS, LABEL_NULLSAFE, AGE_NULLSAFE)}
select {stamp(48)} * from labelled where finding_type is not null"""


def written(job: str) -> str:
    """A job's findings as its history holds them."""
    return f"select *, cast(null as varchar) as notes, date '2024-01-31' as check_date from ({job}) x"


def previewed(job: str, row_id: str, columns: dict[str, str]) -> str:
    """The first 20 findings of each type with a check's own display columns."""
    shown = ", ".join(f"coalesce(cast({column} as varchar), '-') as {name}" for column, name in columns.items())
    return f"""
        select finding_type, cast(position as integer) as position, {shown}, {days_label('data_age_hours')} as age_days
        from (select *, row_number() over (partition by finding_type
                     order by data_age_hours desc nulls first, {row_id}) as position from ({job}) j) x
        where position <= 20"""


# What each check's preview shows, as fixed by the reports people read.
_HOST_SHOWN = {
    "netbox_device_name": "name",
    "netbox_serial": "serial",
    "netbox_site_name": "site",
    "most_recent_source": "source",
    "most_recent_observed": "last_observed",
}
PREVIEWS = {
    "preview_vm_uuid": previewed(JOB_VM_UUID, "netbox_vm_id", {
        "netbox_vm_name": "name",
        "netbox_site_name": "site",
        "netbox_cluster_name": "cluster",
        "netbox_status_value": "status",
        "nutanix_last_observed": "last_observed",
    }),
    "preview_vm_moid": previewed(JOB_VM_MOID, "netbox_vm_id", {
        "netbox_vm_name": "name",
        "netbox_custom_fields_moid": "moid",
        "netbox_musteri": "customer",
        "vmware_last_observed": "last_observed",
    }),
    "preview_host_serial_first": previewed(JOB_HOST_SERIAL_FIRST, "netbox_device_id", _HOST_SHOWN),
    "preview_host_name_first": previewed(
        JOB_HOST_NAME_FIRST, "netbox_device_id", {"netbox_tags1_display": "tag", **_HOST_SHOWN}
    ),
    "preview_cluster": previewed(JOB_CLUSTER, "netbox_cluster_id", {
        "netbox_cluster_name": "name",
        "netbox_cluster_type": "type",
        "most_recent_source": "source",
        "most_recent_observed": "last_observed",
    }),
}

RUN_MOMENTS = (AS_OF, "timestamp '2024-01-30 00:00:00'", "timestamp '2024-01-29 00:00:00'")


# --- monitoring items -------------------------------------------------------

PARSED = rf"""{with_standins("item")},
valued as (select *, trim(lastvalue, {BLANKS}) as v, trim(name, {BLANKS}) as n from item),
parsed as (
  select *,
    trim(regexp_extract(n, '{ITEM_NAME}', 1, 'i'), {BLANKS}) as table_name,
    trim(regexp_extract(n, '{ITEM_NAME}', 2, 'i'), {BLANKS}) as column_name,
    try_cast(lastclock as bigint) as last_clock,
    case cast(event_id % 18 as int)
      when 0 then make_timestamp(try_cast(v as bigint) * 1000000)
      when 1 then strptime(v, '%Y-%m-%d %H:%M:%S')
      when 2 then strptime(v, '%Y-%m-%d %I:%M:%S %p')
      when 3 then strptime(v, '%Y-%m-%dT%H:%M:%S.%gZ')
      when 4 then strptime(v, '%m/%d/%Y %I:%M:%S %p')
      when 5 then strptime(v, '%Y-%m-%d')
      when 6 then strptime(v, '%Y-%m-%d %H:%M')
      when 7 then strptime(left(v, 19), '%Y-%m-%d %H:%M:%S') - interval 3 hour
      when 10 then strptime(left(v, 19), '%Y-%m-%d %H:%M:%S') - interval 3 hour
      when 11 then strptime(left(v, 19), '%Y-%m-%dT%H:%M:%S') - interval 3 hour
      when 12 then strptime(left(v, 26), '%Y-%m-%dT%H:%M:%S.%f')
      when 13 then strptime(left(v, 26), '%Y-%m-%d %H:%M:%S,%f')
      when 14 then strptime(v, '%Y-%m-%dT%H')
      when 15 then strptime(v, '%Y%m%dT%H%M%S')
      when 16 then strptime(left(v, 19), '%Y-%m-%d %H:%M:%S') - interval 3 hour
      when 17 then strptime(v, '%G-W%V-%u')
      when 9 then strptime(replace(v, ' AM', ''), '%Y-%m-%d  %H:%M:%S')
    end as last_data_timestamp
  from valued)"""

STATE_COLUMNS = f"""table_name, column_name, 'db-master' as zabbix_host, itemid as zabbix_item_id, name as zabbix_item_name,
  last_data_timestamp, {float_age("last_data_timestamp")} as data_age_hours, {AS_OF} as check_time, last_clock"""

FRESHNESS = f"""{PARSED},
kept as (select {STATE_COLUMNS} from parsed where table_name <> '' and tag = 'last data' and hostid = '1')"""

ITEM_ORDER = "last_clock desc nulls last, zabbix_item_name, try_cast(zabbix_item_id as bigint), zabbix_item_id"

HISTORY = with_standins("history")

BROKEN = {
    "check_time": ("not null", "o_orderkey % 11 = 0"),
    "netbox_vm_name": ("not null", "o_orderkey % 101 = 0"),
    "nutanix_component_moid": ("at most 255 characters", "o_orderkey % 103 = 0"),
    "data_age_hours": ("fits decimal(10,2)", "o_orderkey % 107 = 0"),
}

ORACLE: dict[str, str] = {
    "table_scan": "select o_orderkey, o_custkey, o_orderdate from orders",
    "paged_json_inventory": f"{with_standins('cluster_record')} {CLUSTERS}",
    "page_chain_faults": """
        with records as (select (cast(c_custkey as integer) - 1) // 50 as page, count(*) as n from customer group by 1),
             kept as (select * from records where page % 11 <> 5),
             landed as (select * from kept union all select * from kept where page % 7 = 3),
             links as (select page + 1 as page, count(*) as n from landed
                       where page < (select max(page) from records) group by 1)
        select (select count(*) from links where page not in (select page from kept)) as missing,
               (select count(*) from kept where page % 7 = 3) as repeated,
               (select count(*) from links where n > 1) as forked,
               (select count(*) from kept where page not in (select page from links)) - 1 as beginnings,
               cast(0 as bigint) as unnamed,
               cast((select sum(n) from records) - (select sum(n) from landed) as bigint) as short""",
    "nested_slug_filter": f"{with_standins('cluster_record')} {CLUSTERS} where type_slug = 'acropolis-cls'",
    "item_feed": f"{with_standins('item')} select itemid, name, lastvalue, lastclock from item",
    "envelope_errors": """
        select cast(-32600 - b as integer) as code, 'Invalid request.' as message, 'batch ' || cast(b as varchar) as data
        from (select distinct event_id // 100 as b from events) x where b % 25 = 0""",
    "items_with_tag": f"""{with_standins('item')}
        select itemid, hostid, cast(2 as integer) as tags from item where tag = 'last data'""",
    "items_of_host": f"{with_standins('item')} select itemid, hostid from item where hostid = '1'",
    "list_relation": """
        with names as (select unnest(['BUILDING', 'HOUSEHOLD', 'SHIPYARD', 'BUILDING']) as name),
             counted as (select c_mktsegment, count(*) as customers from customer group by 1)
        select name, customers from names left join counted on name = c_mktsegment""",
    "prefixed_projection": """
        select c_custkey as inventory_c_custkey, c_name as inventory_c_name, c_mktsegment as inventory_c_mktsegment
        from customer""",
    "tag_contains": "select o_orderkey, o_orderpriority from orders where o_orderpriority like '%I%'",
    "tag_equals": "select o_orderkey, o_orderpriority from orders where o_orderpriority = '2-HIGH'",
    "tag_in_list": "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '5-LOW')",
    "key_not_null": f"""{with_standins('netbox_vm')}
        select id, custom_fields_uuid from netbox_vm where custom_fields_uuid is not null""",
    "key_not_blank": f"""{with_standins('netbox_vm')}
        select id, custom_fields_moid from netbox_vm where custom_fields_moid is not null and custom_fields_moid != ''""",
    "status_exclusion": f"""{with_standins('netbox_vm')}
        select id, status_value from netbox_vm where status_value != 'poweredOff'""",
    "latest_per_key": f"""
        select o_custkey, o_orderkey, o_orderdate, o_totalprice
        from ({latest("orders", "o_custkey", "o_orderdate", "o_orderkey", where="o_orderpriority like '%I%'")}) x""",
    "findings_single": f"{SINGLE} select * from findings",
    "missing_only_anti": f"{SINGLE} select inv_id, inv_ref from findings where finding_type = 'MISSING'",
    "findings_dual_epoch": DUAL_EPOCH,
    "findings_dual_nullsafe": DUAL_NULLSAFE,
    "stamped_findings": f"{SINGLE} select {stamp(24)} * from findings",
    "threshold_instant": f"select event_id, {SINGLE_LIMIT} as limit_at, ts < {SINGLE_LIMIT} as is_stale from events",
    "age_hours": f"select event_id, {age('ts')} as age_hours, {float_age('ts')} as float_age_hours from events",
    "age_days_label": f"""
        select event_id, {days_label('a')} as age_days, (user_id + 1) // 24 as threshold_days
        from (select *, case when user_id % 10 <> 3 then {age('ts')} end as a from events) x""",
    "most_recent_observed": """
        select event_id, greatest(first_ts, second_ts) as most_recent_observed from (
          select event_id, case when event_id % 5 <> 0 then ts end as first_ts,
                 case when event_id % 7 = 0 then ts
                      when event_id % 3 <> 0 then ts + to_hours(cast(user_id % 5 - 2 as integer)) end as second_ts
          from events) x""",
    "most_recent_source": """
        with pairs as (
          select event_id, case when event_id % 5 <> 0 then ts end as first_ts,
                 case when event_id % 7 = 0 then ts
                      when event_id % 3 <> 0 then ts + to_hours(cast(user_id % 5 - 2 as integer)) end as second_ts
          from events),
        known as (
          select event_id, 'FIRST' as source, first_ts as seen_at, 0 as rank from pairs
          union all select event_id, 'SECOND', second_ts, 1 from pairs)
        select event_id, arg_max(source, epoch_us(seen_at) * 10 - rank) filter (seen_at is not null) as most_recent_source
        from known group by event_id""",
    "parsed_timestamps": f"{PARSED} select itemid, last_data_timestamp from parsed",
    "parsed_items": f"""{PARSED}
        select table_name, column_name, itemid as zabbix_item_id, name as zabbix_item_name, last_data_timestamp, last_clock
        from parsed where table_name <> ''""",
    "finding_counts": f"""{SINGLE}
        select count(*) as total, count(*) filter (finding_type = 'STALE') as stale,
               count(*) filter (finding_type = 'MISSING') as missing from findings""",
    "ordered_findings": f"""{SINGLE}
        select *, row_number() over (order by finding_type = 'STALE', data_age_hours desc nulls first, inv_id, event_id)
            as position from findings""",
    "preview_top20": f"""{SINGLE}
        select finding_type, cast(position as integer) as position, cast(inv_id as varchar) as record,
               cast(inv_ref as varchar) as reference, coalesce(cast(obs_key as varchar), '-') as observed_key,
               {days_label('data_age_hours')} as age_days
        from (select *, row_number() over (partition by finding_type
                     order by data_age_hours desc nulls first, inv_id, event_id) as position from findings) x
        where position <= 20""",
    "preview_remaining": f"""{SINGLE}
        select finding_type, count(*) as total, greatest(count(*) - 20, 0) as remaining from findings group by finding_type""",
    "item_parse_counts": f"""{PARSED}
        select count(*) filter (table_name <> '') as parsed, count(*) filter (table_name = '') as skipped from parsed""",
    "stale_table_count": f"""{FRESHNESS}
        select count(*) as tables, count(*) filter (data_age_hours > 168) as stale_tables from kept""",
    "table_report": f"""{FRESHNESS}
        select table_name, column_name, coalesce(strftime(last_data_timestamp, '%Y-%m-%d %H:%M:%S'), 'N/A') as last_data,
               case when data_age_hours is null then '' else printf('(%.1fh)', data_age_hours) end as age,
               case when data_age_hours > 168 then 'STALE' else '' end as marker,
               row_number() over (order by coalesce(data_age_hours, 0) desc, zabbix_item_name,
                                  cast(zabbix_item_id as bigint)) as position
        from kept""",
    "append_findings": written(JOB_VM_UUID),
    "newest_run": written(JOB_VM_UUID),
    "run_summary": " union all ".join(
        f"select {moment} as check_time, count(*) as total, count(*) filter (finding_type = 'STALE') as stale, "
        f"count(*) filter (finding_type = 'MISSING') as missing from ({JOB_VM_UUID.replace(AS_OF, moment)}) x"
        for moment in RUN_MOMENTS
    ),
    "folded_history": " union all ".join(
        f"({written(JOB_VM_UUID.replace(AS_OF, moment))})"
        for moment in (f"timestamp '2024-01-31 {hour:02d}:00:00'" for hour in (3, 6, 9, 12))
    ),
    "dry_run_findings": JOB_VM_UUID,
    "upsert_state": f"""{PARSED},
        rows_in as (select {STATE_COLUMNS}, event_id % 2 as batch from parsed where table_name <> ''),
        old_rows as (select distinct on (table_name, column_name) * from rows_in where batch = 0
                     order by table_name, column_name, {ITEM_ORDER}),
        new_rows as (select distinct on (table_name, column_name) * from rows_in where batch = 1
                     order by table_name, column_name, {ITEM_ORDER})
        select * exclude (batch) from new_rows
        union all
        select * exclude (batch) from old_rows o
        where not exists (select 1 from new_rows n where n.table_name = o.table_name and n.column_name = o.column_name)""",
    "contract_violations": " union all ".join(
        [
            f"select '{column}' as column_name, '{rule}' as rule, count(*) as violations from orders where {condition}"
            for column, (rule, condition) in BROKEN.items()
        ]
        + [
            "select 'finding_type' as column_name, 'not null' as rule, count(*) as violations from orders "
            "where o_orderkey % 109 = 0",
            "select 'finding_type' as column_name, 'at most 20 characters' as rule, count(*) as violations from orders "
            "where o_orderkey % 113 = 0 and o_orderkey % 109 <> 0",
        ]
    ).join(["select * from (", ") x where violations > 0"]),
    "job_vm_uuid": JOB_VM_UUID,
    "job_vm_moid": JOB_VM_MOID,
    "job_host_serial_first": JOB_HOST_SERIAL_FIRST,
    "job_host_name_first": JOB_HOST_NAME_FIRST,
    "job_vm_moid_written": written(JOB_VM_MOID),
    "job_host_staged": written(JOB_HOST_SERIAL_FIRST),
    "job_host_name_first_written": written(JOB_HOST_NAME_FIRST),
    "job_cluster_written": written(JOB_CLUSTER),
    **PREVIEWS,
    "job_cluster": JOB_CLUSTER,
    "job_table_freshness": f"""{FRESHNESS}
        select distinct on (table_name, column_name) * from kept
        order by table_name, column_name, {ITEM_ORDER}""",
    "table_run_counts": f"""{FRESHNESS},
        mine as (select * from parsed where tag = 'last data' and hostid = '1')
        select (select count(*) from (select distinct table_name, column_name from kept) x) as written,
               (select count(*) from mine where table_name <> '') as parsed,
               (select count(*) from mine where table_name = '') as skipped,
               (select count(*) from kept where data_age_hours > 168) as stale""",
    "latest_check_summary": f"""{HISTORY}
        select finding_type, count(*) as count from history
        where check_time = (select max(check_time) from history) group by finding_type""",
    "latest_stale_list": f"""{HISTORY}
        select netbox_vm_name, nutanix_last_observed, data_age_hours, netbox_cluster_name,
               row_number() over (order by data_age_hours desc nulls first, event_id) as position
        from history
        where check_time = (select max(check_time) from history) and finding_type = 'STALE'""",
    "finding_trend_rows": f"""{HISTORY}
        select *, row_number() over (order by check_date desc, finding_type) as position from (
          select cast(check_time as date) as check_date, finding_type, count(*) as count from history group by all) x""",
    "finding_trend": "select *, cast(row_number() over (order by check_date desc, finding_type) as integer) as position "
    "from (select cast(check_time as date) as check_date, finding_type, count(*) as count from ("
    + " union all ".join(f"select check_time, finding_type from ({JOB_VM_UUID.replace(AS_OF, moment)}) x" for moment in RUN_MOMENTS)
    + ") y group by all) z",
    "logged_summary": f"select finding_type, count(*) as count from ({JOB_VM_UUID}) x group by finding_type",
}
