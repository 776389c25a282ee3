"""Backup and restore queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import backup as b
from lakewarden.plans.ingest import orders_in_versions
from lakewarden.plans.registry import query
from lakewarden.session import fresh_dir

CREATED = "2024-01-31T00:00:00.000Z"
MANIFEST = ("manifest", "stored_files")


# Text files, so that SQL can rebuild their bytes: a file per range of keys, its lines in order.
BODIES = """
bodies as (
  select o_orderkey // 4096 as key, string_agg(concat(o_orderkey, ',', o_custkey, ',', o_orderpriority), chr(10) order by o_orderkey) || chr(10) as body
  from orders group by 1)"""
BLOCK = 4096


def line():
    return F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority")


def text_files(t, value):
    root = fresh_dir(t.spark, "manifest")
    lines = t.orders.select(F.expr("o_orderkey div 4096").alias("key"), "o_orderkey", value.alias("value"))
    lines.repartition("key").sortWithinPartitions("key", "o_orderkey").select("key", "value").write.partitionBy("key").text(root)
    return root


def by_key(found):
    return found.withColumn("key", F.regexp_extract("path", r"key=(\d+)/", 1).cast("long"))


@query("backup_manifest", sql="with " + BODIES + """
select key, cast(octet_length(encode(body)) as bigint) as size, sha256(body) as checksum, 'data' as type from bodies""")
def backup_manifest(t):
    return by_key(b.file_manifest(t.spark, text_files(t, line()))).select("key", "size", "checksum", "type")


BLOCKS = BODIES + f""",
blocks as (
  select key, length(body) as size, (length(body) + {BLOCK - 1}) // {BLOCK} as blocks, block, block * {BLOCK} as start
    , substr(body, block * {BLOCK} + 1, {BLOCK}) as part, substr(replace(body, '0,', 'O,'), block * {BLOCK} + 1, {BLOCK}) as other
  from (select *, unnest(range((length(body) + {BLOCK - 1}) // {BLOCK})) as block from bodies))"""


@query("backup_blocks", sql="with " + BLOCKS + " select key, size, blocks, block, start, sha256(part) as checksum from blocks")
def backup_blocks(t):
    return by_key(b.block_manifest(t.spark, text_files(t, line()), block_bytes=BLOCK)).select("key", "size", "blocks", "block", "start", "checksum")


@query("backup_changed_blocks", sql="with " + BLOCKS + """
select distinct key, block, start, 'block_changed' as issue from blocks where part <> other""")
def backup_changed_blocks(t):
    """Blocks that differ after each "0," of the lines has become "O,", which shifts nothing."""
    folder = F.substring_index("path", "part-", 1)  # holds one file, whose name is new in each write
    recorded, stored = (
        b.relative_to(b.block_manifest(t.spark, root, block_bytes=BLOCK), root)
        for root in (text_files(t, line()), text_files(t, F.replace(line(), F.lit("0,"), F.lit("O,")))))
    changed = b.changed_blocks(recorded.withColumn("path", folder), stored.withColumn("path", folder))
    return by_key(changed).select("key", "block", "start", "issue")


@query("backup_export", sql=f"""
select substr(sha256('warehouse_orders_{CREATED}'), 1, 16) as backup_id, o_orderkey, o_totalprice
from orders where o_orderdate < '2000-01-01'""")
def backup_export(t):
    table = orders_in_versions(t)
    made, path = b.export_snapshot(table.read(1), fresh_dir(t.spark, "backups"), "warehouse", "orders", CREATED)
    return t.spark.read.parquet(path).select(F.lit(made).alias("backup_id"), "o_orderkey", "o_totalprice")


INTEGRITY = """
integrity as (
  select m.backup_id, m.path as file, 'error' as severity, i.issue
  from manifest m left join stored_files s on m.backup_id = s.backup_id and m.path = s.path
    , (values ('file_missing'), ('checksum_mismatch'), ('size_mismatch')) as i(issue)
  where (i.issue = 'file_missing' and s.path is null) or (i.issue = 'checksum_mismatch' and s.checksum <> m.checksum)
    or (i.issue = 'size_mismatch' and s.size <> m.size))"""
COMPLETENESS = """
facts as (
  select backup_id, count(*) filter (type = 'log') as logs, count(*) filter (type = 'data') as data
    , count(*) filter (type = 'log' and path like '%00000000000000000000.json') as first_log
    , max(try_cast(substr(path, 12, 20) as bigint)) filter (type = 'log') as last_v, max(format_version) as fv
    , count(*) filter (path like '%_delta_log%') as dl
  from manifest group by 1),
complete as (
  select backup_id, '' as file, 'error' as severity, 'missing_log_files' as issue from facts where logs = 0
  union all select backup_id, '', 'error', 'missing_protocol' from facts where first_log = 0
  union all select backup_id, '', 'error', 'missing_metadata' from facts where first_log = 0
  union all select backup_id, '', 'warning', 'no_data_files' from facts where data = 0
  union all
  select backup_id, concat('version ', case when v - p = 2 then cast(v - 1 as varchar) else concat(p + 1, ' to ', v - 1) end), 'warning', 'version_gap'
  from (
    select backup_id, v, coalesce(lag(v) over (partition by backup_id order by v), -1) as p
    from (select distinct backup_id, try_cast(substr(path, 12, 20) as bigint) as v from manifest where type = 'log') where v is not null)
  where v - p > 1)"""


@query("backup_integrity", views=MANIFEST, sql="with " + INTEGRITY + " select * from integrity")
def backup_integrity(t):
    return b.integrity_issues(t.manifest, t.stored_files)


@query("backup_completeness", views=MANIFEST, sql="with " + COMPLETENESS + " select * from complete")
def backup_completeness(t):
    return b.completeness_issues(t.manifest)


@query("backup_restorable", views=MANIFEST, sql="with " + INTEGRITY + "," + COMPLETENESS + """,
issues as (
  select backup_id, severity from integrity union all select backup_id, severity from complete
  union all select backup_id, 'error' from facts where fv <> 1 union all select backup_id, 'error' from facts where dl = 0)
select f.backup_id, count(*) filter (severity = 'error') as errors, count(*) filter (severity = 'warning') as warnings
  , count(*) filter (severity = 'error') = 0 as valid
from facts f left join issues i on f.backup_id = i.backup_id group by 1""")
def backup_restorable(t):
    return b.restorability(t.manifest, t.stored_files)


@query("backup_restore", sql="select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def backup_restore(t):
    root = fresh_dir(t.spark, "restore")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    _, path = b.export_snapshot(rows, f"{root}/backups", "warehouse", "orders", CREATED)
    recorded = f"{root}/manifest"
    b.file_manifest(t.spark, path).write.parquet(recorded)
    return b.restore(t.spark, path, t.spark.read.parquet(recorded), f"{root}/target", b.content_hash(rows))


@query("backup_preview", views=MANIFEST, sql="""
select backup_id, count(*) as files, cast(sum(size) as bigint) as total_size
  , greatest(1, cast(sum(size) // 10485760 as bigint)) as estimated_seconds
from manifest group by 1""")
def backup_preview(t):
    return b.restore_preview(t.manifest)


@query("backup_list", views=MANIFEST, sql="""
select backup_id, count(*) as files, 'crm' as source, 'accounts' as "table" from manifest group by 1
having min(file_no) % 2 = 0""")
def backup_list(t):
    root = fresh_dir(t.spark, "headers")
    headers = t.manifest.groupBy("backup_id").agg(F.count("*").alias("files"), F.min("file_no").alias("n")).select(
        "backup_id", "files", F.when(F.col("n") % 2 == 0, "crm").otherwise("erp").alias("source"), F.lit("accounts").alias("table"))
    b.write_headers(headers, root)
    return b.list_backups(t.spark, root, "backup_id string, files bigint", source="crm", table="accounts")


@query("retention_age", sql="""
select o_orderkey, o_orderdate from orders where o_orderdate < timestamp '2001-08-02 00:00:00' - interval 365 day""")
def retention_age(t):
    return b.older_than(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "2001-08-02 00:00:00", 365)
