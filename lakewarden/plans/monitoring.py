"""Metric, health and alert queries over the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import alerts as a, monitoring as m
from lakewarden.operators.monitoring import HealthRule
from lakewarden.plans.drift import REPORT, full_report
from lakewarden.plans.registry import query
from lakewarden.plans.sync import PHASES
from lakewarden.plans.validation import OBJECTS, rounded, yearly_objects

AS_OF = "2024-01-31 00:00:00"
WEEK = "2024-01-24 00:00:00"  # a week before, the start of an hour
HOURLY = "hourly as (select date_trunc('hour', ts) as ts, event_type as metric, avg(sqrt(value)) as value, count(*) as n from events group by 1, 2)"


def hourly(t, since: str | None = None):
    """Hourly metric per event type, of events from ``since`` on; the root keeps means off rounding ties."""
    events = t.events if since is None else t.events.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return events.groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("metric")
    ).agg(F.avg(F.sqrt("value")).alias("value"), F.count("*").alias("n"))


@query("metric_trend", sql="with " + HOURLY + """,
x as (select *, epoch_us(ts) / 1e6 - epoch_us(timestamp '2024-01-24 00:00:00') / 1e6 as x from hourly where ts > timestamp '2024-01-24 00:00:00'),
f as (select metric, regr_slope(value, x) as slope, regr_r2(value, x) as r2, count(*) as data_points, max(x) - min(x) as span_s from x group by 1)
select metric, round(slope, 9) as slope, round(r2, 6) as r2, data_points, span_s
  , case when slope > 0.01 then 'increasing' when slope < -0.01 then 'decreasing' else 'stable' end as direction
  , case when r2 > 0.7 then 'strong' when r2 > 0.3 then 'moderate' else 'weak' end as strength
from f where data_points >= 2""")
def metric_trend(t):
    return rounded(rounded(m.trend(hourly(t, WEEK), AS_OF, 7 * 86400), "slope", places=9), "r2")


@query("metric_trailing_avg", sql="with " + HOURLY + """
select ts, metric, round(avg(value) over (partition by metric order by ts range between interval '23 hours 59 minutes' preceding and current row), 6) as trailing_average
from hourly""")
def metric_trailing_avg(t):
    out = m.trailing_average(hourly(t), 86400).select("ts", "metric", "trailing_average")
    return rounded(out, "trailing_average")


@query("metric_window_avg", sql="with " + HOURLY + """
select metric, round(avg(value), 6) as average, count(*) as data_points from hourly
where ts > timestamp '2024-01-24 00:00:00' group by 1""")
def metric_window_avg(t):
    return rounded(m.window_average(hourly(t, WEEK), AS_OF, 7 * 86400), "average")


@query("metric_recent", sql="with " + HOURLY + """
select ts, metric, round(value, 6) as value, n from hourly
qualify row_number() over (partition by metric order by ts desc) <= 50""")
def metric_recent(t):
    return rounded(m.recent(hourly(t), 50), "value")


@query("metric_anomalies", sql="with " + HOURLY + """,
b as (
  select *, count(*) over w as c, avg(value) over w as mean, stddev_pop(value) over w as spread from hourly
  window w as (partition by metric order by ts rows between unbounded preceding and 1 preceding)),
z as (select *, (value - mean) / spread as z from b where c >= 10 and spread > 0)
select metric, ts, round(value, 6) as value, round(mean, 6) as mean, round(spread, 6) as spread, round(z, 6) as z_score
  , case when abs(z) > 4 then 'critical' else 'warning' end as severity
from z where abs(z) > 2""")
def metric_anomalies(t):
    return rounded(m.anomalies(hourly(t), 2.0).drop("expected_range"), "value", "mean", "spread", "z_score")


RULES = (
    HealthRule("agent_failure_rate", "failure_rate", critical=0.25, severity="critical"),
    HealthRule("workflow_completion", "success_rate", warning=0.8, below=True),
    HealthRule("disk_usage", "disk_usage_percent", warning=60.0, critical=80.0),
    HealthRule("memory_usage", "memory_usage_percent", warning=70.0, critical=90.0),
    HealthRule("api_response_time", "api_response_time_ms", warning=1500.0, critical=3000.0),
    HealthRule("validation_error_rate", "validation_error_rate", warning=0.02, critical=0.3),
    HealthRule("schema_drift", "schema_drift_score", warning=0.4, critical=0.7),
)

HEALTH = """
ticks as (
  select date_trunc('hour', ts) as ts, count(*) as n, count(*) filter (event_type = 'error') as e
    , avg(value) filter (event_type = 'click') as d, avg(value) filter (event_type = 'view') as mm, max(value) * 10 as r
  from events group by 1),
long as (
  select ts, 'failure_rate' as metric, e / n as value from ticks
  union all select ts, 'success_rate', 1 - e / n from ticks
  union all select ts, 'disk_usage_percent', d from ticks where d is not null
  union all select ts, 'memory_usage_percent', mm from ticks where mm is not null
  union all select ts, 'api_response_time_ms', r from ticks),
results as (
  select ts, metric, value
    , case metric when 'failure_rate' then 'agent_failure_rate' when 'success_rate' then 'workflow_completion'
        when 'disk_usage_percent' then 'disk_usage' when 'memory_usage_percent' then 'memory_usage' else 'api_response_time' end as rule
    , case metric when 'failure_rate' then 'critical' else 'warning' end as rule_severity
    , case metric when 'failure_rate' then case when value > 0.25 then 'critical' else 'ok' end
        when 'success_rate' then case when value < 0.8 then 'warning' else 'ok' end
        when 'disk_usage_percent' then case when value > 80 then 'critical' when value > 60 then 'warning' else 'ok' end
        when 'memory_usage_percent' then case when value > 90 then 'critical' when value > 70 then 'warning' else 'ok' end
        else case when value > 3000 then 'critical' when value > 1500 then 'warning' else 'ok' end end as status
  from long)"""


def health_metrics(t):
    def only(kind: str):
        return F.avg(F.when(F.col("event_type") == kind, F.col("value")))

    ticks = t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e"),
        only("click").alias("disk_usage_percent"), only("view").alias("memory_usage_percent"),
        (F.max("value") * 10).alias("api_response_time_ms"))
    wide = ticks.withColumn("failure_rate", F.col("e") / F.col("n")).withColumn(
        "success_rate", 1 - F.col("e") / F.col("n")).drop("e", "n")
    names = [c for c in wide.columns if c != "ts"]
    return wide.unpivot("ts", names, "metric", "value").where("value is not null")


def quality_metrics(t):
    """Error rate of each year's validation and drift score of each object, as metric rows."""
    rates = yearly_objects(t).select(
        F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("ts"), F.lit("validation_error_rate").alias("metric"),
        F.col("error_rate").alias("value"))
    drift = full_report(t).select(
        F.lit(AS_OF).cast("timestamp_ntz").alias("ts"), F.lit("schema_drift_score").alias("metric"),
        F.col("overall_score").cast("double").alias("value"))
    return rates.unionByName(drift)


def limits(value: str, warning: str, critical: str) -> str:
    return f"""case when {value} > {critical} then 'critical' when {value} > {warning} then 'warning' else 'ok' end
  , case when {value} > {critical} then {critical} when {value} > {warning} then {warning} end"""


@query("health_rules", views=("orders_faulty",), sql="with " + HEALTH + "," + OBJECTS + "," + REPORT + f"""
select ts, metric, rule, rule_severity, status, round(value, 6) as value
  , case when status = 'ok' then null when metric = 'failure_rate' then 0.25 when metric = 'success_rate' then 0.8
      when metric = 'disk_usage_percent' then if(status = 'critical', 80, 60) when metric = 'memory_usage_percent' then if(status = 'critical', 90, 70)
      else if(status = 'critical', 3000, 1500) end::double as threshold from results
union all
select make_date(y, 1, 1), 'validation_error_rate', 'validation_error_rate', 'warning', s, round(error_rate, 6), b
from (select y, error_rate, {limits('error_rate', '0.02', '0.3').replace('end', 'end as s', 1)}::double as b from objects)
union all
select timestamp '{AS_OF}', 'schema_drift_score', 'schema_drift', 'warning', s, round(overall_score, 6), b
from (select overall_score, {limits('overall_score', '0.4', '0.7').replace('end', 'end as s', 1)}::double as b from report)""")
def health_rules(t):
    found = m.check_rules(health_metrics(t).unionByName(quality_metrics(t)), RULES)
    return rounded(found.drop("message"), "value")


@query("health_status", sql="with " + HEALTH + """
select ts, count(*) as checked, count(*) filter (status <> 'ok') as failing
  , case when count(*) filter (status <> 'ok' and (rule_severity = 'critical' or status = 'critical')) > 0 then 'critical'
      when count(*) filter (status = 'warning') > 0 then 'warning' else 'ok' end as overall_status
from results group by 1""")
def health_status(t):
    return m.overall_health(m.check_rules(health_metrics(t), RULES), ["ts"])


# Every next alert of a type that is at least six hours after the one sent before.
CHAIN = """
first_sent as (select event_type, min(ts) as ts from events group by 1),
chain as (
  select event_type, ts from first_sent
  union all
  select n.event_type, n.ts from (
    select c.event_type, (select min(e.ts) from events e where e.event_type = c.event_type and e.ts >= c.ts + interval 6 hour) as ts
    from chain c) n
  where n.ts is not null)"""


def sent_alerts(t):
    alerts = t.events.select("event_id", "event_type", "ts")
    return a.cooldown(alerts, "event_type", "ts", "event_id", cooldown_s=6 * 3600)


@query("alert_cooldown", sql="with recursive " + CHAIN + """
select event_id, e.event_type, e.ts from events e join chain c on e.event_type = c.event_type and e.ts = c.ts""")
def alert_cooldown(t):
    return sent_alerts(t)


@query("alert_history", sql="with recursive " + CHAIN + """
select event_type, max(ts) as last_fired, count(*) as sent from chain group by 1""")
def alert_history(t):
    return a.alert_history(sent_alerts(t), "event_type", "ts")


@query("error_patterns", sql="with e as (" + PHASES.format(events="events") + """),
d as (
  select 'error_type' as dimension, concat('type_', cast(event_id % 3 as varchar)) as value from e
  union all select 'phase', phase from e
  union all select 'object', cast(object as varchar) from e
  union all select 'total', '' from e)
select dimension, value, count(*) as errors, count(*) / 100.0 as sync_error_rate from d group by 1, 2""")
def error_patterns(t):
    errors = t.spark.sql(PHASES, events=t.events).withColumn(
        "error_type", F.concat(F.lit("type_"), (F.col("event_id") % 3).cast("string")))
    return m.error_patterns(errors, ["error_type", "phase", "object"])


@query("retry_patterns", sql="""
select event_type as operation, count(*) as attempts, count(*) filter (event_id % 7 <> 0) as successful
  , count(*) filter (event_id % 7 = 0) as failed, round(avg(value), 6) as average_delay
  , round(count(*) filter (event_id % 7 <> 0) / count(*), 6) as recovery_rate
from events group by 1""")
def retry_patterns(t):
    attempts = t.events.select(F.col("event_type").alias("operation"), (F.col("event_id") % 7 != 0).alias("success"),
                               F.col("value").alias("delay"))
    return rounded(m.retry_patterns(attempts), "average_delay", "recovery_rate")
