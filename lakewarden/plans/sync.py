"""Sync decisions, state and consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import consistency as c, schemas, sync
from lakewarden.plans.registry import query
from lakewarden.plans.schemas import DIFF, HASH

AS_OF = "2024-01-31 00:00:00"

PREVIOUS = """
select object, name, type from {schema_before}
where cast(substr(object, 6) as int) % 5 <> 0"""


def stored_state(t):
    no = F.substring("object", 6, 20).cast("int")
    return schemas.fingerprint(t.schema_before).where(no % 6 != 0).select(
        "object", F.when(no % 29 == 0, "").otherwise(F.col("schema_hash")).alias("schema_hash"),
        (no % 4 + 1).alias("schema_version"))


@query("sync_plan", views=("catalog", "schema_before", "schema_after"), sql="with " + DIFF + f""",
prev as ({PREVIOUS.format(schema_before="schema_before")}),
state as (
  select object, case when cast(substr(object, 6) as int) % 29 = 0 then '' else h end as schema_hash
    , cast(substr(object, 6) as int) % 4 + 1 as v
  from (select object, {HASH} as h from schema_before group by 1) where cast(substr(object, 6) as int) % 6 <> 0),
fresh as (select object, {HASH} as h from schema_after group by 1),
broken as (select object from diff where change in ('removed', 'type_changed') group by 1),
r as (
  select c.object, c.allowed, s.object is null as first
    , coalesce(s.schema_hash <> '' and f.h <> s.schema_hash, false) as changed
    , c.object in (select object from prev) as has_prev, c.object in (select object from broken) as broken, s.v
  from catalog c left join state s on c.object = s.object left join fresh f on c.object = f.object)
select object
  , case when not allowed then 'skip' when first or (changed and (not has_prev or broken)) then 'full' else 'incremental' end as mode
  , case when not allowed then 'not in allowed objects list' when first then 'no prior sync state'
      when changed and not has_prev then 'schema changed (no prior schema for diffing)'
      when changed and broken then 'breaking schema change detected' else 'incremental from watermark' end as reason
  , allowed and not first and changed as schema_changed
  , cast(case when not allowed then null when first then 1 when changed then v + 1 else v end as int) as new_version
from r""")
def sync_plan(t):
    previous = t.spark.sql(PREVIOUS, schema_before=t.schema_before)
    catalog = t.catalog
    return sync.plan(catalog.select("object"), t.schema_after, stored_state(t), previous,
                     allowed=catalog.where("allowed"))


@query("state_advance", sql="""
with prior as (
  select concat('user_', cast(user_id as varchar)) as object, max(ts) as last_sync, max(ts) as watermark, count(*) as total_records
  from events where ts < '2024-01-15' and user_id % 10 <> 0 group by user_id),
fresh as (
  select concat('user_', cast(user_id as varchar)) as object, max(ts) as wm, count(*) as n
  from events where ts >= '2024-01-29' and event_type = 'purchase' group by user_id)
select coalesce(p.object, f.object) as object
  , case when f.n is not null then timestamp '2024-01-31 00:00:00' else last_sync end as last_sync
  , case when f.n is not null then greatest(watermark, wm) else watermark end as watermark
  , coalesce(total_records, 0) + coalesce(n, 0) as total_records, coalesce(n, 0) as last_records
from prior p full outer join fresh f on p.object = f.object""")
def state_advance(t):
    named = t.events.withColumn("object", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    prior = named.where((F.col("ts") < "2024-01-15") & (F.col("user_id") % 10 != 0)).groupBy("object").agg(
        F.max("ts").alias("last_sync"), F.max("ts").alias("watermark"), F.count("*").alias("total_records"))
    written = named.where((F.col("ts") >= "2024-01-29") & (F.col("event_type") == "purchase"))
    return sync.advance_state(prior, written, "object", "ts", AS_OF)


STALE = """
stale as (
  select object, epoch_us(timestamp '2024-01-31 00:00:00') / 1e6 - epoch_us(last_sync) / 1e6 as age, coalesce(max_age_s, 86400) as lim
  from object_state left join object_windows using (object)),
stale_rows as (
  select 'staleness' as type, object as parent, cast(null as varchar) as dependent
    , case when age / lim > 4 then 'critical' when age / lim > 2 then 'high' when age / lim > 1.5 then 'medium' else 'low' end as severity
    , round(age, 3) as amount_s
  from stale where age > lim)"""
MISSING = """
missing_rows as (
  select 'missing_object' as type, parent, dependent, 'high' as severity, cast(null as double) as amount_s
  from object_edges where parent in (select object from object_state) and dependent not in (select object from object_state))"""
PAIRS = """
pairs as (
  select parent, dependent, (epoch_us(p.watermark) - epoch_us(d.watermark)) / 1e6 as drift
    , abs(epoch_us(p.last_sync) - epoch_us(d.last_sync)) / 1e6 as gap
  from object_edges e join object_state p on e.parent = p.object join object_state d on e.dependent = d.object),
drift_rows as (
  select 'watermark_drift' as type, parent, dependent
    , case when drift > 86400 then 'critical' when drift > 43200 then 'high' when drift > 21600 then 'medium' else 'low' end as severity
    , round(drift, 3) as amount_s
  from pairs where drift > 3600),
gap_rows as (
  select 'transaction_boundary' as type, parent, dependent, 'medium' as severity, round(gap, 3) as amount_s
  from pairs where gap > 21600)"""
STATE_VIEWS = ("object_state", "object_edges", "object_windows")


def seconds3(df):
    return df.withColumn("amount_s", F.round("amount_s", 3))


@query("consistency_staleness", views=STATE_VIEWS, sql="with " + STALE + " select * from stale_rows")
def consistency_staleness(t):
    return seconds3(c.staleness(t.object_state, AS_OF, t.object_windows))


@query("consistency_missing", views=STATE_VIEWS, sql="with " + MISSING + " select * from missing_rows")
def consistency_missing(t):
    return c.missing_dependents(t.object_state, t.object_edges)


@query("consistency_drift", views=STATE_VIEWS, sql="with " + PAIRS + " select * from drift_rows")
def consistency_drift(t):
    return seconds3(c.watermark_drift(t.object_state, t.object_edges))


@query("consistency_gap", views=STATE_VIEWS, sql="with " + PAIRS + " select * from gap_rows")
def consistency_gap(t):
    return seconds3(c.sync_gap(t.object_state, t.object_edges))


@query("consistency_report", views=STATE_VIEWS, sql="with " + STALE + "," + MISSING + "," + PAIRS + """,
v as (select severity from stale_rows union all select 'high' from (select distinct parent from missing_rows)
  union all select severity from drift_rows union all select severity from gap_rows)
select count(*) as violations, count(*) filter (severity = 'low') as low, count(*) filter (severity = 'medium') as medium
  , count(*) filter (severity = 'high') as high, count(*) filter (severity = 'critical') as critical
  , case when count(*) = 0 then 'healthy' when count(*) filter (severity = 'critical') > 0 then 'unhealthy' else 'degraded' end as status
from v""")
def consistency_report(t):
    return c.report(c.violations(t.object_state, t.object_edges, AS_OF, t.object_windows))


@query("state_validate", views=("state_rows",), sql="""
select row_no, 'source must be a non-empty string' as issue from state_rows where source = ''
union all select row_no, 'missing required field: objects' from state_rows where object is null
union all select row_no, 'object name cannot be empty' from state_rows where object = ''
union all select row_no, 'invalid schema version' from state_rows where schema_version < 0
union all select row_no, 'invalid sync type' from state_rows where sync_type not in ('', 'full', 'incremental')""")
def state_validate(t):
    return sync.state_issues(t.state_rows, ["row_no"])


@query("retry_queue", views=("failures",), sql="""
select event_id, object, attempts, last_attempt, cast(least((attempts - 1) * 3600, 7200) as bigint) as delay_s
from failures
where attempts < 4 and timestamp '2024-01-30 12:00:00' > last_attempt + interval 1 second * least((attempts - 1) * 3600, 7200)""")
def retry_queue(t):
    return sync.retry_queue(t.failures, "2024-01-30 12:00:00", 3600, 7200, 4)


PHASES = """
select event_id, user_id as object, case event_id % 8 when 0 then 'connect' when 1 then 'discover' when 2 then 'extract'
  when 3 then 'transform' when 4 then 'store' when 5 then 'commit' when 6 then 'validate' else 'other' end as phase
from {events} where event_type = 'error'"""


@query("error_rollup", sql="with e as (" + PHASES.format(events="events") + """),
advice(phase, advice) as (values """ + ", ".join(
    f"('{k}', '{text}')" for k, text in sync.PHASE_ADVICE.items()) + f""")
select e.phase, object, count(*) as errors, coalesce(any_value(advice), '{sync.OTHER_ADVICE}') as advice
from e left join advice a on e.phase = a.phase group by 1, 2""")
def error_rollup(t):
    return sync.error_rollup(t.spark.sql(PHASES, events=t.events), ["phase", "object"])
