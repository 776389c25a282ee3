"""Security-event and issue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import events as e
from lakewarden.plans.registry import query
from lakewarden.plans.validation import rounded

VIEWS = ("security_events",)


@query("event_counts", views=VIEWS, sql="""
select source, type, count(*) as events, case type when 'auth_failure' then 'auth_failures' when 'file_access' then 'file_access_violations'
  when 'network_anomaly' then 'network_anomalies' when 'data_integrity' then 'data_integrity_violations' else 'memory_anomalies' end as category
from security_events group by 1, 2""")
def event_counts(t):
    return e.category_counts(t.security_events, ["source"])


SCORE = """100 - 2.0 * least(50, count(*) filter (type = 'auth_failure')) - 1.5 * least(20, count(*) filter (type = 'network_anomaly'))
  - 1.8 * least(10, count(*) filter (type = 'file_access')) - 1.2 * least(30, count(*) filter (type = 'memory_anomaly'))
  - 8.0 * least(2, count(*) filter (type = 'data_integrity'))"""


@query("event_score", views=VIEWS, sql=f"""
select source, round(cast(greatest(0, {SCORE}) as double), 6) as score from security_events group by 1""")
def event_score(t):
    return rounded(e.event_score(t.security_events, ["source"]), "score")


@query("event_alerts", views=VIEWS, sql="""
with n as (
  select *, count(*) filter (type = 'auth_failure') over (order by ts, event_id rows between unbounded preceding and current row) as failures
  from security_events)
select event_id, ts, type, severity, 'Security Event: ' || type as title from n
where severity in ('high', 'critical') or (type = 'auth_failure' and failures >= 40)""")
def event_alerts(t):
    return e.event_alerts(t.security_events, 40).drop("source")


@query("event_recent", views=VIEWS, sql="""
select event_id, ts, type, severity from security_events where ts > timestamp '2024-01-28 00:00:00'
order by ts desc, event_id desc limit 60""")
def event_recent(t):
    return e.recent_events(t.security_events.drop("source"), "2024-01-31 00:00:00", 60, window_s=3 * 86400)


@query("event_report", views=VIEWS, sql=f"""
with c as (
  select count(*) as total_issues, count(*) filter (severity = 'low') as low, count(*) filter (severity = 'medium') as medium
    , count(*) filter (severity = 'high') as high, count(*) filter (severity = 'critical') as critical from security_events),
k as (
  select greatest(0, {SCORE}) as score, count(*) filter (type = 'auth_failure') as a, count(*) filter (type = 'memory_anomaly') as m from security_events)
select c.*, high + critical as high_severity, round(cast(score as double), 6) as score, round(cast(100 - score as double), 6) as risk
  , concat_ws('; ', case when a > 10 then 'Investigate authentication failures' end, case when m > 5 then 'Address memory anomalies' end
    , case when total_issues > 50 then 'Review security monitoring configuration' end) as advice
from c, k""")
def event_report(t):
    return rounded(e.event_report(t.security_events), "score", "risk")


@query("event_trend", views=VIEWS, sql="""
with ticks as (
  select epoch_us(ts) // 30000000 as k, count(*) filter (type = 'auth_failure') as a
    , count(*) filter (type = 'network_anomaly') as n, count(*) filter (type = 'memory_anomaly') as m
  from security_events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-31' group by 1),
every as (
  select unnest(range(epoch_us(timestamp '2024-01-10') // 30000000, epoch_us(timestamp '2024-01-31') // 30000000)) as k),
newest as (
  select to_timestamp(k * 30) at time zone 'UTC' as tick, coalesce(sum(a) over w, 0) as a, coalesce(sum(n) over w, 0) as n
    , coalesce(sum(m) over w, 0) as m from every left join ticks using (k) window w as (order by k))
select tick, 'auth_failures' as category, cast(a as bigint) as value from newest
union all select tick, 'network_anomalies', cast(n as bigint) from newest
union all select tick, 'memory_anomalies', cast(m as bigint) from newest
union all select tick, 'process_anomalies', 0 from newest""")
def event_trend(t):
    return e.event_trend(t.security_events, "2024-01-10 00:00:00", "2024-01-31 00:00:00")


@query("issue_dedup", sql="""
with log as (
  select user_id as subject, event_type as type, concat('message ', cast(event_id % 3 as varchar)) as message, ts, event_id as seq
    , event_id % 2 = 0 as resolved from events),
f as (
  select subject, type, message, count(*) as n, min(ts) as first_seen, max(ts) as last_seen, max_by(resolved, ts) as resolved
    , bool_or(resolved) as ever from log group by 1, 2, 3)
select subject, type, message, n, first_seen, last_seen, resolved, ever and not resolved as reopened from f
where not (resolved and last_seen <= timestamp '2024-01-30 00:00:00')""")
def issue_dedup(t):
    log = t.events.select(
        F.col("user_id").alias("subject"), F.col("event_type").alias("type"),
        F.concat(F.lit("message "), (F.col("event_id") % 3).cast("string")).alias("message"), "ts",
        F.col("event_id").alias("seq"), (F.col("event_id") % 2 == 0).alias("resolved"))
    return e.fold_issues(log, "2024-01-31 00:00:00")
