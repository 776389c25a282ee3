"""Schema queries over schemas derived from what was shipped."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import schemas as s
from lakewarden.operators.rules import Field
from lakewarden.plans.registry import query

HASH = """substr(sha256('[' || string_agg('{"name":"' || name || '","type":"' || type || '"}', ',' order by name) || ']'), 1, 16)"""

DIFF = """
diff as (
  select coalesce(b.object, a.object) as object, coalesce(b.name, a.name) as name, b.type as old_type, a.type as new_type
    , case when b.type is null then 'added' when a.type is null then 'removed'
        when b.type <> a.type then 'type_changed' end as change
  from schema_before b full outer join schema_after a on b.object = a.object and b.name = a.name)"""


@query("schema_fingerprint", views=("schema_before",), sql=f"""
select object, {HASH} as schema_hash, count(distinct name) as n_fields from schema_before group by 1""")
def schema_fingerprint(t):
    return s.fingerprint(t.schema_before)


@query("schema_diff", views=("schema_before", "schema_after"), sql="with " + DIFF + """
select * from diff where change is not null""")
def schema_diff(t):
    return s.diff(t.schema_before, t.schema_after)


@query("schema_classify", views=("schema_before", "schema_after"), sql="with " + DIFF + """
select object, count(*) filter (change = 'added') as added, count(*) filter (change = 'removed') as removed
  , count(*) filter (change = 'type_changed') as type_changed
  , case when count(*) filter (change in ('removed', 'type_changed')) > 0 then 'breaking'
      when count(*) filter (change = 'added') > 0 then 'additive' else 'none' end as classification
from diff group by 1""")
def schema_classify(t):
    return s.classify(t.schema_before, t.schema_after)


@query("schema_history", views=("schema_snapshots",), sql=f"""
with prints as (select object, taken, {HASH} as schema_hash, count(distinct name) as n_fields from schema_snapshots group by 1, 2),
marked as (select *, lag(schema_hash) over (partition by object order by taken) as b from prints)
select object, cast(taken as int) as taken, schema_hash, n_fields
  , cast(row_number() over (partition by object order by taken) as int) as version
from marked where b is null or b <> schema_hash""")
def schema_history(t):
    return s.history(t.schema_snapshots, "taken")


@query("schema_conform", sql="""
select o_orderkey, o_totalprice, case when o_orderdate >= '1998-01-01' then o_orderpriority end as o_orderpriority
from orders""")
def schema_conform(t):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    early = orders.where(F.col("o_orderdate") < "1998-01-01").select("o_orderkey", "o_totalprice")
    late = orders.where(F.col("o_orderdate") >= "1998-01-01").drop("o_orderdate")
    fields = [Field("o_orderkey", "long"), Field("o_totalprice", "double"), Field("o_orderpriority", "string")]
    return s.conform(s.union_versions([early, late]), fields)
