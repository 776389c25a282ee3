"""Derived inputs: faults, logs and catalogues that the clean tables do not hold.

Each view is one SQL text valid in Spark and in the checking database; a
``{name}`` stands for a given table or another view.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    # Rows with injected faults, as text, the way an untyped extract delivers them.
    "orders_faulty": """
select o_orderkey
  , case when o_orderkey % 97 = 0 then null else cast(o_custkey as string) end as o_custkey
  , case when o_orderkey % 89 = 0 then 'n/a' else cast(o_totalprice as string) end as o_totalprice
  , case when o_orderkey % 83 = 0 then ' ' else o_orderstatus end as o_orderstatus
  , case when o_orderkey % 79 = 0 then '9-BOGUS' else o_orderpriority end as o_orderpriority
  , concat('user', cast(o_custkey as string), case when o_orderkey % 71 = 0 then '' else '@example.com' end) as contact_email
  , o_orderdate
from {orders}""",
    # File actions of a versioned table: adds per year and priority, low priority removed two versions on.
    "actions": """
select version, path, 'add' as action, size
from (
  select year(o_orderdate) - 1994 as version
    , concat('orders/', cast(year(o_orderdate) as string), '/', o_orderpriority) as path, count(*) * 100 as size
  from {orders} group by 1, 2) a
union all
select version + 2 as version, path, 'remove' as action, cast(null as bigint) as size
from (
  select distinct year(o_orderdate) - 1994 as version
    , concat('orders/', cast(year(o_orderdate) as string), '/', o_orderpriority) as path
  from {orders} where o_orderpriority = '5-LOW') b""",
    "events_daily": """
select cast(ts as date) as day, event_type
  , case when event_id % 7 = 0 and day(ts) > 20 then null else value end as value
from {events}""",
    "recordings": """
select event_id as request_id
  , case when event_id % 5 = 0 then 'POST' else 'get' end as method
  , concat('https://api.example.com/', event_type, case when event_id % 3 = 0 then '/detail' else '' end) as url
  , case when event_id % 11 = 0 then 500 else 200 end as status
  , cast(floor(value * 100) as bigint) as duration_ms, props as body
from {events}""",
    # An endpoint per part, some of which end others, and calls for parts.
    "part_endpoints": """
select case when p_partkey % 2 = 0 then 'GET' else 'post' end as method
  , case p_partkey % 3
    when 0 then concat('/parts/', p_partkey, '/lines/', p_partkey % 4)
    when 1 then concat(p_partkey % 100, '/lines/', p_partkey % 7)
    else concat('/lines/', p_partkey) end as path
  , cast(p_size * 100 as bigint) as timeout_ms, p_size as grade
from {part}""",
    "part_calls": """
select l_orderkey * 8 + l_linenumber as request_id
  , case when l_linenumber % 2 = 0 then 'get' else 'POST' end as method
  , concat('https://api.example.com/parts/', l_partkey, '/lines/', l_suppkey % 4) as url
  , case when l_returnflag = 'R' then 500 else 200 end as status
  , cast(l_quantity * 200 as bigint) as duration_ms
from {lineitem}""",
    # One schema per part and year: two fields whose type follows what was shipped.
    "schema_snapshots": """
select concat('part_', cast(l_partkey as string)) as object, year(l_shipdate) as taken
  , concat('field_', cast(l_linenumber % 3 as string)) as name
  , case min(l_returnflag) when 'A' then 'string' when 'N' then 'double' else 'long' end as type
from {lineitem} group by 1, 2, 3""",
    # The same objects at two points: everything finished, and everything open.
    "schema_before": """
select concat('part_', cast(l_partkey as string)) as object
  , concat('field_', cast(l_linenumber as string)) as name
  , case when min(l_returnflag) = 'A' then 'string' else 'double' end as type
from {lineitem} where l_linestatus = 'F' group by 1, 2""",
    "schema_after": """
select concat('part_', cast(l_partkey as string)) as object
  , concat('field_', cast(l_linenumber as string)) as name
  , case when min(l_returnflag) = 'A' then 'string' else 'double' end as type
from {lineitem} where l_linestatus = 'O' or l_quantity > 25 group by 1, 2""",
    "catalog": """
select concat('part_', cast(p_partkey as string)) as object, p_name as label
  , p_size % 7 <> 0 as queryable, p_size % 3 <> 0 as replicateable
  , p_brand <> 'Brand#13' as allowed
from {part}""",
    # Sync state per user of the event log; the watermark lags behind by the errors.
    "object_state": """
select concat('user_', cast(user_id as string)) as object, user_id as object_no
  , max(ts) as last_sync, max(case when event_type = 'error' then ts end) as watermark
  , count(*) as total_records
from {events} group by user_id""",
    "object_edges": """
select distinct concat('user_', cast(user_id as string)) as parent
  , concat('user_', cast(user_id + 1 as string)) as dependent
from {events}
union
select concat('user_', cast(user_id as string)) as parent
  , concat('user_', cast(user_id + 7 as string)) as dependent
from {events}""",
    "object_windows": """
select distinct concat('user_', cast(user_id as string)) as object, 3600 * (1 + user_id % 5) as max_age_s
from {events} where user_id % 3 = 0""",
    # Saved state rows, some of them malformed.
    "state_rows": """
select case when o_orderkey % 101 = 0 then '' else o_orderpriority end as source
  , case when o_orderkey % 103 = 0 then '' when o_orderkey % 107 = 0 then null
      else concat('object_', cast(o_orderkey as string)) end as object
  , case when o_orderkey % 109 = 0 then -1 else o_custkey end as schema_version
  , case o_orderkey % 5 when 0 then '' when 1 then 'full' when 2 then 'incremental' when 3 then null
      else case when o_orderkey % 113 = 0 then 'partial' else 'full' end end as sync_type
  , o_orderkey as row_no
from {orders}""",
    # Materialised table states, one per customer, with structural faults.
    "saved_states": """
select o_custkey as version
  , case when o_orderkey % 11 = 0 then 'protocol' when o_orderkey % 11 = 1 then 'metaData'
      when o_orderkey % 41 = 2 then 'remove' else 'add' end as action
  , case when o_orderkey % 61 = 0 then '' else concat('part-', cast(o_orderkey as string)) end as path
  , cast(floor(o_totalprice) as bigint) * case when o_orderkey % 67 = 0 then -1 else 1 end as size
from {orders}""",
    # Backup manifests, one backup per customer and about one file per order.
    "manifest": """
select backup_id, path, type, min(o_orderkey) as file_no, cast(floor(min(o_totalprice)) as bigint) * 1024 as size
  , concat('c', cast(min(o_orderkey) as string)) as checksum, min(format_version) as format_version
from (
  select concat('backup_', cast(o_custkey as string)) as backup_id, o_orderkey, o_totalprice
    , case when o_orderkey % 3 = 0
        then concat('_delta_log/', lpad(cast(o_orderkey % 5 as string), 20, '0'), '.json')
        else concat('data/part-', cast(o_orderkey as string), '.parquet') end as path
    , case when o_orderkey % 3 = 0 then 'log' when o_orderkey % 17 = 1 then 'checkpoint' else 'data' end as type
    , case when o_custkey % 19 = 0 then 2 else 1 end as format_version
  from {orders}) f
group by 1, 2, 3""",
    "stored_files": """
select backup_id, path, file_no
  , case when file_no % 59 = 0 then size + 1 else size end as size
  , case when file_no % 53 = 0 then 'damaged' else checksum end as checksum
from {manifest} where file_no % 47 <> 0""",
    "failures": """
select event_id, user_id as object, ts as last_attempt, 1 + event_id % 4 as attempts
from {events} where event_type = 'error'""",
    "findings": """
select event_id as seq, concat(event_type, '_', cast(user_id as string)) as package, cast(cast(floor(value * 10) as bigint) % 100 as double) / 10 as cvss
  , case when event_id % 4 = 0 then null else concat('1.', cast(event_id % 9 as string)) end as fixed_in
from {events}""",
    "security_events": """
select event_id, ts, user_id as source
  , case event_type when 'error' then 'auth_failure' when 'click' then 'file_access' when 'view' then 'network_anomaly'
      when 'purchase' then 'data_integrity' else 'memory_anomaly' end as type
  , case event_id % 4 when 0 then 'low' when 1 then 'medium' when 2 then 'high' else 'critical' end as severity
from {events}""",
}


def tables_in(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def with_views(names: tuple[str, ...], sql: str) -> str:
    """Put the named views, and the views they use, in front of a query as CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in tables_in(VIEWS[name]):
            if dep in VIEWS:
                add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} as (" + re.sub(r"\{(\w+)\}", r"\1", VIEWS[n]) + ")" for n in ordered]
    body = sql.strip()
    head = re.match(r"with\s+(recursive\s+)?", body, re.IGNORECASE)
    if head:
        body = body[head.end():]
        return "with recursive " + ", ".join([*parts, body]) if parts else "with recursive " + body
    return ("with recursive " + ", ".join(parts) + " " if parts else "") + body
