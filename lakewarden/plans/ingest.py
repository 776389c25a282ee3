"""Scans, extracts, sinks and the versioned write."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lakewarden.operators.rules import Field
from lakewarden.plans.registry import query
from lakewarden.session import fresh_dir
from lakewarden.sources import extracts, sinks
from lakewarden.sources.versioned import VersionedTable


@query("scan_typed", sql="""
select l_orderkey, l_quantity, l_returnflag from lineitem where l_quantity > 40""")
def scan_typed(t):
    fields = [Field("l_orderkey", "long"), Field("l_quantity", "double"), Field("l_returnflag", "string")]
    return extracts.scan_parquet(t.spark, t.path("lineitem"), fields).where(F.col("l_quantity") > 40)


@query("sink_roundtrip", sql="""
select count(*) as n, cast(sum(o_orderkey) as bigint) as keys, count(distinct o_orderpriority) as priorities
  , true as within_batch from orders""")
def sink_roundtrip(t):
    path = fresh_dir(t.spark, "sink")
    sinks.write_batches(t.orders, path, rows_per_file=10_000)
    files = sinks.written_files(t.spark, path).agg(
        F.sum("num_records").alias("n_files_rows"), (F.max("num_records") <= 10_000).alias("within_batch"))
    rows = t.spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"),
        F.count_distinct("o_orderpriority").alias("priorities"))
    return rows.join(files, F.col("n") == F.col("n_files_rows")).drop("n_files_rows")


@query("csv_extract", sql="""
select c_custkey, case when c_custkey % 10 = 0 then null else c_name end as c_name
  , case when c_custkey % 7 = 0 then null else c_acctbal end as c_acctbal
from customer""")
def csv_extract(t):
    path = fresh_dir(t.spark, "csv")
    name = F.when(F.col("c_custkey") % 10 == 0, F.lit("")).otherwise(F.col("c_name"))
    rows = t.customer.select("c_custkey", name.alias("c_name"), "c_acctbal")
    short = F.col("c_custkey") % 7 == 0
    rows.where(~short).write.csv(path, header=True, emptyValue="")
    rows.where(short).drop("c_acctbal").write.mode("append").csv(path, header=True, emptyValue="")
    fields = [Field("c_custkey", "long"), Field("c_name", "string"), Field("c_acctbal", "double")]
    return extracts.cast_declared(
        extracts.scan_delimited(t.spark, path, ["c_custkey", "c_name", "c_acctbal"]), fields)


@query("json_pages", sql="""
select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events""")
def json_pages(t):
    path = fresh_dir(t.spark, "pages")
    record = F.struct(
        F.struct(F.lit("Event").alias("type")).alias("attributes"), "event_id", "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"))
    pages = (
        t.events.withColumn("page", F.floor(F.col("event_id") / 200))
        .groupBy("page").agg(F.collect_list(record).alias("records"))
        .select("records", F.lit(True).alias("done"))
    )
    empty = pages.select(F.filter("records", lambda r: F.lit(False)).alias("records"), "done")
    pages.unionByName(empty).write.json(path)
    return extracts.scan_json_pages(
        t.spark, path, "attributes:struct<type:string>,event_id:bigint,event_type:string,k:bigint")


@query("extract_full", sql="select c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey from customer")
def extract_full(t):
    return extracts.full_snapshot(t.customer)


@query("extract_incremental", sql="""
select event_id, ts, event_type, value from events where ts > timestamp '2024-01-20 12:30:15.123'""")
def extract_incremental(t):
    return extracts.incremental(
        t.events.select("event_id", "ts", "event_type", "value"), "ts", "2024-01-20 12:30:15.123999", tie=["event_id"])


@query("catalog_discover", views=("catalog",), sql="""
select object, label, replicateable
  , case when replicateable then 'SystemModstamp' else 'LastModifiedDate' end as watermark_field
from catalog where queryable""")
def catalog_discover(t):
    return extracts.discover_catalog(t.catalog.select("object", "label", "queryable", "replicateable")).drop("queryable")


SOURCE_FIELDS = """
select p.p_partkey, k.source_type
from {part} p join (values (0, 'string'), (1, 'textarea'), (2, 'url'), (3, 'email'), (4, 'phone'), (5, 'picklist')
  , (6, 'multipicklist'), (7, 'combobox'), (8, 'reference'), (9, 'id'), (10, 'encryptedstring'), (11, 'int')
  , (12, 'long'), (13, 'double'), (14, 'currency'), (15, 'percent'), (16, 'boolean'), (17, 'date')
  , (18, 'datetime'), (19, 'base64'), (20, 'anyType'), (21, 'location')) as k(i, source_type)
  on p.p_partkey % 22 = k.i"""


@query("map_source_types", sql="with f as (" + SOURCE_FIELDS.format(part="part") + """)
select p_partkey, source_type, case
    when source_type = 'int' then 'integer' when source_type = 'long' then 'long'
    when source_type in ('double', 'currency', 'percent') then 'double' when source_type = 'boolean' then 'boolean'
    when source_type = 'date' then 'date' when source_type = 'datetime' then 'datetime'
    when source_type = 'base64' then 'binary' else 'string' end as logical_type
from f""")
def map_source_types(t):
    return extracts.map_source_types(t.spark.sql(SOURCE_FIELDS, part=t.part))


def orders_in_versions(t) -> VersionedTable:
    """Orders as a versioned table: first load, one increment, then a full refresh."""
    table = VersionedTable.create(t.spark, fresh_dir(t.spark, "orders-table"))
    orders = t.orders
    table.commit(orders.where(F.col("o_orderdate") < "1998-01-01"))
    table.commit(extracts.incremental(orders, "o_orderdate", "1997-12-31", ordered=False)
                 .where(F.col("o_orderdate") < "2000-01-01"))
    table.commit(orders.where(F.col("o_orderstatus") != "P"), replace=True)
    return table


@query("versioned_write", sql="""
select 0 as version, 'add' as action, count(*) as n from orders where o_orderdate < '1998-01-01'
union all
select 1, 'add', count(*) from orders where o_orderdate >= '1998-01-01' and o_orderdate < '2000-01-01'
union all
select 2, 'add', count(*) from orders where o_orderstatus <> 'P'
union all
select 2, 'remove', count(*) from orders where o_orderdate < '2000-01-01'""")
def versioned_write(t):
    """Rows that each version adds, and those that a replacement leaves behind."""
    table = orders_in_versions(t)
    rows = None
    for version in range(table.latest() + 1):
        part = t.spark.read.parquet(table.folder(version)).agg(F.count("*").alias("n")).withColumn("version", F.lit(version))
        rows = part if rows is None else rows.unionByName(part)
    eras = Window.orderBy("version")  # a row per version
    found = table.versions().join(rows, "version").withColumn("era", F.count_if(F.col("kind") == "replace").over(eras))
    begun = found.where("kind = 'replace'").select("version", (F.col("era") - 1).alias("era"))
    gone = found.groupBy("era").agg(F.sum("n").alias("n")).join(begun, "era")
    return found.select("version", F.lit("add").alias("action"), "n").unionByName(
        gone.select("version", F.lit("remove").alias("action"), "n"))
