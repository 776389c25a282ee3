"""Versioned-table reads and action-log analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import versions as vs
from lakewarden.plans.ingest import orders_in_versions
from lakewarden.plans.registry import query
from lakewarden.session import fresh_dir
from lakewarden.sources.action_log import file_actions, scan_log

SNAPSHOT_5 = """
snap as (
  select path, max_by(action, version * 2 + cast(action = 'add' as int)) as action
    , max_by(size, version * 2 + cast(action = 'add' as int)) filter (action = 'add') as size
    , max(version) as added_in
  from actions where version <= 5 group by path having max_by(action, version * 2 + cast(action = 'add' as int)) = 'add')"""


@query("log_scan", views=("actions",), sql="""
select cast(version as bigint) as version, action, count(*) as n, cast(sum(size) as bigint) as size from actions group by 1, 2""")
def log_scan(t):
    path = fresh_dir(t.spark, "log")
    line = F.when(F.col("action") == "add", F.to_json(F.struct(F.struct("path", "size").alias("add")))).otherwise(
        F.to_json(F.struct(F.struct("path").alias("remove"))))
    name = F.format_string("%020d.json", F.col("version").cast("long"))
    t.actions.select(name.alias("log"), line.alias("value")).write.partitionBy("log").text(path)
    log = file_actions(scan_log(t.spark, path))
    return log.groupBy("version", "action").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@query("log_latest", views=("actions",), sql="select cast(coalesce(max(version), -1) as int) as version from actions")
def log_latest(t):
    return vs.latest_version(t.actions)


@query("snapshot_files", views=("actions",), sql="with " + SNAPSHOT_5 + " select path, cast(added_in as int) as added_in, size from snap")
def snapshot_files(t):
    return vs.snapshot_files(t.actions, 5)


@query("time_travel", sql="""
select 0 as at, o_orderkey, o_totalprice from orders where o_orderdate < '1998-01-01'
union all
select 1, o_orderkey, o_totalprice from orders where o_orderdate < '2000-01-01'
union all
select 2, o_orderkey, o_totalprice from orders where o_orderstatus <> 'P'""")
def time_travel(t):
    table = orders_in_versions(t)
    out = None
    for at in (0, 1, 2):
        rows = table.read(at).select(F.lit(at).alias("at"), "o_orderkey", "o_totalprice")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("log_volume", views=("actions",), sql="""
select count(*) as files, cast(coalesce(sum(size), 0) as bigint) as bytes
  , cast(coalesce(sum(size), 0) // 1048576 as bigint) as mib
from actions where action = 'add' and version > 2 and version <= 5""")
def log_volume(t):
    return vs.data_volume(t.actions, 2, 5)


STRUCTURE = """
counts as (
  select version, count(*) filter (action = 'protocol') as p, count(*) filter (action = 'metaData') as m
  from saved_states where version is not null group by 1),
faults as (
  select version, p - 1 as times, 'Multiple protocol actions found' as description, 'error' as severity from counts where p > 1
  union all select version, m - 1, 'Multiple metadata actions found', 'error' from counts where m > 1
  union all select version, 1, 'No protocol action found', 'error' from counts where p = 0
  union all select version, 1, 'No metadata action found', 'error' from counts where m = 0
  union all select version, 1, 'Add action missing path', 'error' from saved_states where action = 'add' and path = ''
  union all select version, 1, 'Add action has negative size', 'error' from saved_states where action = 'add' and size < 0
  union all select version, 1, 'Remove action found in checkpoint', 'warning' from saved_states where action = 'remove')"""


@query("ckpt_structure", views=("saved_states",), sql="with " + STRUCTURE + """
select version, 'structure' as type, description, severity, cast(times as bigint) as times from faults""")
def ckpt_structure(t):
    return vs.structure_issues(t.saved_states)


@query("ckpt_vs_snapshot", views=("actions",), sql="with " + SNAPSHOT_5 + """,
saved as (
  select path, case when path like '%1-URGENT' then size + 1 else size end as size from snap where path not like '%2-HIGH'
  union all select concat('extra/', path), size from snap where path like '%2-HIGH')
select coalesce(s.path, x.path) as path
  , case when s.path is null then 'completeness' else 'consistency' end as type
  , case when s.path is null then 'Expected file missing from checkpoint'
      when x.path is null then 'Unexpected file in checkpoint' else 'File size mismatch' end as description
  , 'error' as severity
from saved s full outer join snap x on s.path = x.path
where s.path is null or x.path is null or s.size <> x.size""")
def ckpt_vs_snapshot(t):
    snap = vs.snapshot_files(t.actions, 5)
    saved = snap.select(
        F.when(F.col("path").like("%2-HIGH"), F.concat(F.lit("extra/"), "path")).otherwise(F.col("path")).alias("path"),
        F.when(F.col("path").like("%1-URGENT"), F.col("size") + 1).otherwise(F.col("size")).alias("size"))
    return vs.state_against_snapshot(saved, snap)


@query("dangling_files", views=("actions",), sql="with " + SNAPSHOT_5 + """
select path, 'integrity' as type, 'error' as severity from snap
where path not in (select concat('orders/', cast(year(o_orderdate) as varchar), '/', o_orderpriority)
  from orders where o_orderpriority <> '3-MEDIUM')""")
def dangling_files(t):
    stored = t.orders.where(F.col("o_orderpriority") != "3-MEDIUM").select(F.concat(
        F.lit("orders/"), F.year("o_orderdate").cast("string"), F.lit("/"), "o_orderpriority").alias("path"))
    return vs.dangling_files(vs.snapshot_files(t.actions, 5), stored)


@query("ckpt_newest_valid", views=("saved_states",), sql="with " + STRUCTURE + """
select coalesce(max(version), -1) as version from saved_states
where version <= 1000000000 and version not in (select version from faults where severity = 'error')""")
def ckpt_newest_valid(t):
    return vs.newest_valid_state(t.saved_states, 1_000_000_000)


@query("retention_newest_n", sql="""
select o_orderkey, o_custkey, o_orderdate from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) > 5""")
def retention_newest_n(t):
    files = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return vs.beyond_newest(files, ["o_custkey"], ["o_orderdate", "o_orderkey"], 5)
