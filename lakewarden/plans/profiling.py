"""Operation and resource queries over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import profiling as p
from lakewarden.plans.registry import query
from lakewarden.plans.validation import rounded

AS_OF = "2024-01-31 00:00:00"
WEEK = 7 * 86400


def op_log(t, by_user: bool = False):
    op = F.concat_ws(".", "event_type", F.col("user_id").cast("string")) if by_user else F.col("event_type")
    return t.events.select(op.alias("op"), "ts", (F.col("value") / 10).alias("duration"),
                           (F.col("event_type") == "error").alias("is_error"), "event_id")


@query("op_metrics", sql="""
select event_type as op, count(*) as n, round(sum(value / 10), 4) as total_time, min(value / 10) as min_time
  , max(value / 10) as max_time, round(avg(value / 10), 9) as avg_time
  , count(*) filter (event_type = 'error') as errors, max(ts) as last_updated
from events group by 1""")
def op_metrics(t):
    return rounded(rounded(p.operation_metrics(op_log(t)), "total_time", places=4), "avg_time", places=9)


PERCENTILES = """
ranked as (
  select event_type, value / 10 as duration, row_number() over (partition by event_type order by value / 10, event_id) - 1 as i
    , count(*) over (partition by event_type) as n
  from events),
ranks as (
  select event_type as op, max(duration) filter (i = n * 50 // 100) as p50, max(duration) filter (i = n * 95 // 100) as p95
    , max(duration) filter (i = n * 99 // 100) as p99
  from ranked group by 1)"""


@query("op_percentiles", sql="with " + PERCENTILES + " select * from ranks")
def op_percentiles(t):
    return p.percentiles(op_log(t))


# One resource series per event type: memory in bytes grows with the value seen in the hour.
SAMPLES = """
samples as (
  select date_trunc('hour', ts) as ts, event_type as metric, cast(floor(max(value) * 1e9) as bigint) as memory
    , count(*) * 1500 as goroutines, max(event_id) as gc_count, count(*) * 0.05 as gc_pause_s
  from events group by 1, 2)"""


def samples(t):
    return t.events.groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("metric")).agg(
        F.floor(F.max("value") * 1e9).alias("memory"), (F.count("*") * 1500).alias("goroutines"),
        F.max("event_id").alias("gc_count"), (F.count("*") * F.lit(0.05)).alias("gc_pause_s"))


SUMMARY = """
inside as (select *, ts > timestamp '2024-01-24 00:00:00' as recent from samples),
summary as (
  select metric, cast(floor(avg(memory) filter (recent)) as bigint) as avg_memory, max(memory) filter (recent) as peak_memory
    , cast(floor(avg(goroutines) filter (recent)) as bigint) as avg_goroutines, max(goroutines) filter (recent) as peak_goroutines
    , max_by(gc_count, ts) as gc_count, cast(max_by(gc_pause_s, ts) as double) as gc_pause_s
  from inside group by 1)"""
TREND = """
ends as (
  select metric, count(*) filter (ts >= timestamp '2024-01-24 00:00:00') as samples
    , max(ts) filter (ts >= timestamp '2024-01-24 00:00:00') as last_updated
    , min(ts) filter (ts >= timestamp '2024-01-24 00:00:00') as t0
    , min_by(memory, ts) filter (ts >= timestamp '2024-01-24 00:00:00') as v0
    , max_by(memory, ts) filter (ts >= timestamp '2024-01-24 00:00:00') as current
    , max(memory) filter (ts >= timestamp '2024-01-24 00:00:00') as peak
    , cast(floor(avg(memory) filter (ts >= timestamp '2024-01-24 00:00:00')) as bigint) as average
  from samples group by 1),
rates as (
  select *, (current - v0) / nullif((epoch_us(last_updated) - epoch_us(t0)) / 1e6, 0) as r from ends),
trend as (
  select metric, samples, last_updated, current, peak, average, coalesce(r, 0) as rate
    , case when samples = 0 then 'unknown' when r > 102400 then 'increasing' when r < -102400 then 'decreasing' else 'stable' end as direction
  from rates)"""


@query("resource_summary", sql="with " + SAMPLES + "," + SUMMARY + """
select metric, avg_memory, peak_memory, avg_goroutines, peak_goroutines, gc_count, round(gc_pause_s, 6) as gc_pause_s from summary""")
def resource_summary(t):
    return rounded(p.resource_summary(samples(t), ["metric"], AS_OF, WEEK), "gc_pause_s")


@query("resource_trend", sql="with " + SAMPLES + "," + TREND + """
select metric, samples, last_updated, current, peak, average, round(rate, 4) as rate, direction from trend""")
def resource_trend(t):
    return rounded(p.resource_trend(samples(t), ["metric"], AS_OF, WEEK), "rate", places=4)


@query("resource_leak", sql="with " + SAMPLES + "," + TREND + """
select metric, round(rate, 4) as rate from trend where direction = 'increasing' and rate > 1000
union all
select concat('falling_', metric), round(-rate, 4) from trend where direction = 'decreasing' and -rate > 1000""")
def resource_leak(t):
    found = p.resource_trend(samples(t), ["metric"], AS_OF, WEEK)
    # Memory running the other way, so that both directions are seen.
    mirrored = found.withColumns({
        "metric": F.concat(F.lit("falling_"), "metric"), "rate": -F.col("rate"),
        "direction": F.when(F.col("direction") == "decreasing", "increasing").otherwise("stable")})
    both = p.resource_leaks(found, 1000.0).unionByName(p.resource_leaks(mirrored, 1000.0))
    return rounded(both.select("metric", "rate"), "rate", places=4)


BOTTLENECKS = SAMPLES + "," + SUMMARY + "," + TREND + "," + PERCENTILES + """,
ops as (select event_type as op, count(*) filter (event_type = 'error') / count(*) as er from events group by 1),
bott as (
  select 'latency' as type, op as operation, case when p95 > 30 then 'critical' when p95 > 10 then 'high' else 'medium' end as severity
    , p95 / 30 as impact, 'Consider optimizing the operation or adding caching' as suggestion from ranks where p95 > 5
  union all
  select 'errors', op, case when er > 0.2 then 'critical' when er > 0.1 then 'high' else 'medium' end, er
    , 'Investigate error causes and improve error handling' from ops where er > 0.05
  union all
  select 'memory', metric, case when rate > 104857600 then 'critical' when rate > 10485760 then 'high' else 'medium' end, rate / 104857600
    , 'Check for memory leaks and optimize memory usage' from trend where direction = 'increasing' and rate > 1048576
  union all
  select 'goroutines', metric, case when peak_goroutines > 10000 then 'critical' when peak_goroutines > 5000 then 'high' else 'medium' end
    , peak_goroutines / 10000, 'Review goroutine lifecycle management and prevent goroutine leaks' from summary where peak_goroutines > 1000)"""


def found_bottlenecks(t):
    log, resources = op_log(t), p.resource_report(samples(t), ["metric"], AS_OF, WEEK)
    return p.bottlenecks(p.operation_metrics(log), p.percentiles(log), resources), resources


@query("bottlenecks", sql="with " + BOTTLENECKS + """
select type, operation, severity, round(impact, 6) as impact, suggestion from bott""")
def bottlenecks(t):
    return rounded(found_bottlenecks(t)[0], "impact")


@query("bottleneck_advice", sql="with " + BOTTLENECKS + """
select case severity when 'critical' then 4 else 3 end as rank, round(impact, 6) as impact, operation, suggestion as advice
from bott where severity in ('high', 'critical')
union all
select 0, 0, 'system', 'Monitor memory allocation patterns and implement regular profiling'
from trend having count(*) filter (direction = 'increasing') > 0
union all
select 0, 0, 'system', 'Consider tuning GC parameters to reduce pause times'
from summary having count(*) filter (gc_pause_s > 0.1) > 0""")
def bottleneck_advice(t):
    return rounded(p.ranked_advice(*found_bottlenecks(t)), "impact")


@query("op_expiry", sql="""
select concat(event_type, '.', cast(user_id as varchar)) as op, count(*) as n, max(ts) as last_updated
from events group by 1 having max(ts) >= timestamp '2024-01-30 00:00:00'""")
def op_expiry(t):
    return p.live_operations(op_log(t, by_user=True), AS_OF).select("op", "n", "last_updated")
