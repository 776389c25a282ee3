"""Drift queries over daily statistics of the event log."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lakewarden.operators import drift as d
from lakewarden.operators.validation import validation_alerts
from lakewarden.plans.registry import query
from lakewarden.plans.validation import rounded

# The root keeps means off rounding ties. value is missing more often after day 20, k only on the last days.
WIDE = """
select event_type, date_trunc('day', ts) as day
  , case when event_id % 7 = 0 and day(ts) > 20 then null else sqrt(value) end as value
  , case when day(ts) >= 29 and event_id % 3 <> 0 then null else event_id % 10 end as k
from {events}"""


def wide(t):
    return t.spark.sql(WIDE, events=t.events).withColumn("day", F.col("day").cast("timestamp_ntz"))


def history(t):
    return d.snapshots(wide(t), ["value", "k"], "event_type", "day", distinct=None)


def shares(t):
    """Share of each event type per user and day."""
    counted = t.events.groupBy(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("object"), F.lit("event_type").alias("field"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("snapshot_ts"), F.col("event_type").alias("value_type"),
    ).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("object", "snapshot_ts")
    return counted.withColumn("share", F.col("n") / F.sum("n").over(whole)).drop("n")


HISTORY = """
wide as (""" + WIDE.format(events="events") + """),
history as (
  select event_type as object, 'value' as field, day as snapshot_ts, count(value) as non_null_count
    , count(*) - count(value) as null_count, count(value) / count(*) as population_rate, avg(value) as mean
    , min(value) as min, max(value) as max, stddev_pop(value) as stddev, count(distinct value) as unique_values from wide group by 1, 3
  union all
  select event_type, 'k', day, count(k), count(*) - count(k), count(k) / count(*), avg(k)
    , cast(min(k) as double), cast(max(k) as double), stddev_pop(k), count(distinct k) from wide group by 1, 3)"""

PAST = """
past as (
  select *, avg(population_rate) over w as pop_avg, avg(mean) over w as mean_avg, count(*) over w as before
    , count(*) over (partition by object, field) as samples
    , max(snapshot_ts) over (partition by object, field) = snapshot_ts as latest
  from history window w as (partition by object, field order by snapshot_ts rows between unbounded preceding and 1 preceding)),
pop as (
  select *, abs(population_rate - pop_avg) / pop_avg as change from past where before > 0 and pop_avg > 0),
mea as (
  select *, abs(mean - mean_avg) / abs(mean_avg) as change from past where before > 0 and abs(mean_avg) > 0.001)"""


def severity(x: str) -> str:
    return f"case when {x} > 0.5 then 'high' when {x} > 0.2 then 'medium' else 'low' end"


@query("drift_snapshots", sql="with " + HISTORY + """
select object, field, snapshot_ts, non_null_count, null_count, round(population_rate, 6) as population_rate
  , round(1 - population_rate, 6) as null_rate, unique_values, min, max, round(mean, 6) as mean, round(stddev, 6) as stddev
from history""")
def drift_snapshots(t):
    out = d.snapshots(wide(t), ["value", "k"], "event_type", "day", distinct="exact")
    out = out.drop("value_type", "average_length")
    return rounded(rounded(out, "population_rate", "null_rate"), "mean", "stddev")


@query("drift_history", sql="with " + HISTORY + """
select object, field, snapshot_ts, round(population_rate, 6) as population_rate from history
qualify row_number() over (partition by object, field order by snapshot_ts desc) <= 7""")
def drift_history(t):
    return rounded(d.trim(history(t), 7).select("object", "field", "snapshot_ts", "population_rate"), "population_rate")


@query("drift_merge", sql="with " + HISTORY + """,
joined as (
  select object, field, snapshot_ts, population_rate, 0 as side from history where snapshot_ts < timestamp '2024-01-20'
  union all
  select object, field, snapshot_ts + interval 400 millisecond, population_rate / 2, 1 from history where snapshot_ts >= timestamp '2024-01-15'),
best as (
  select * from joined qualify row_number() over (
    partition by object, field, date_trunc('second', snapshot_ts) order by side desc, snapshot_ts desc) = 1)
select object, field, snapshot_ts, round(population_rate, 6) as population_rate from best
qualify row_number() over (partition by object, field order by snapshot_ts desc) <= 20""")
def drift_merge(t):
    h = history(t).select("object", "field", "snapshot_ts", "population_rate")
    stored = h.where(F.col("snapshot_ts") < "2024-01-20")
    new = h.where(F.col("snapshot_ts") >= "2024-01-15").select(
        "object", "field", (F.col("snapshot_ts") + F.expr("interval 400 milliseconds")).alias("snapshot_ts"),
        (F.col("population_rate") / 2).alias("population_rate"))
    return rounded(d.merge(stored, new, 20), "population_rate")


def drift_columns(kind: str, current: str, average: str) -> str:
    return f"""object, field, snapshot_ts, '{kind}' as drift_type, {severity('change')} as severity
  , round({current}, 6) as current_value, round({average}, 6) as historical_average, round(change * 100, 4) as change_percent"""


def tidy(df):
    return rounded(rounded(df, "current_value", "historical_average"), "change_percent", places=4)


@query("drift_population", sql="with " + HISTORY + "," + PAST + f"""
select {drift_columns('population', 'population_rate', 'pop_avg')} from pop where change > 0.1""")
def drift_population(t):
    return tidy(d.population_drift(history(t), 0.1, latest=False))


@query("drift_mean", sql="with " + HISTORY + "," + PAST + f"""
select {drift_columns('statistical', 'mean', 'mean_avg')} from mea where change > 0.1""")
def drift_mean(t):
    return tidy(d.mean_drift(history(t), 0.1, latest=False))


SHARES = """
counted as (
  select concat('user_', cast(user_id as varchar)) as object, cast(cast(ts as date) as timestamp) as snapshot_ts, event_type, count(*) as n
  from events group by 1, 2, 3),
shares as (select *, n / sum(n) over (partition by object, snapshot_ts) as share from counted),
span as (select object, max(snapshot_ts) as last_ts, count(distinct snapshot_ts) as samples from shares group by 1),
typed as (
  select s.object, last_ts, samples, event_type
    , coalesce(sum(share) filter (snapshot_ts = last_ts), 0) as now, coalesce(sum(share) filter (snapshot_ts < last_ts), 0) as past
  from shares s join span p on s.object = p.object group by 1, 2, 3, 4),
moved as (
  select object, last_ts as snapshot_ts, samples, sum(abs(now - past / (samples - 1))) as change
  from typed where samples > 1 group by 1, 2, 3)"""


@query("drift_types", sql="with " + SHARES + f"""
select object, 'event_type' as field, snapshot_ts, 'type' as drift_type, {severity('change')} as severity
  , round(change, 6) as current_value, cast(0 as double) as historical_average, round(change * 100, 4) as change_percent
from moved where change > 0.1""")
def drift_types(t):
    return tidy(d.type_drift(shares(t), 0.1))


REPORT = HISTORY + "," + PAST + "," + SHARES + f""",
found as (
  select object, field, 'population' as kind, {severity('change')} as severity from pop where latest and samples >= 10 and change > 0.05
  union all select object, field, 'statistical', {severity('change')} from mea where latest and samples >= 10 and change > 0.05
  union all select object, 'event_type', 'type', {severity('change')} from moved where samples >= 10 and change > 0.05),
fields as (
  select object, count(*) as fields from (
    select object, field from history group by 1, 2 having count(*) >= 10
    union select object, 'event_type' from span where samples >= 10) group by 1),
sums as (
  select object, count(*) as drifts, count(*) filter (severity = 'high') as high, count(distinct field) as drifting_fields
    , sum(case severity when 'high' then 1.0 when 'medium' then 0.6 else 0.3 end) as score
    , string_agg(distinct field, ' ' order by field) filter (kind = 'population') as pf
    , string_agg(distinct field, ' ' order by field) filter (kind = 'type') as tf
  from found group by 1),
report as (
  select f.object, fields, coalesce(drifts, 0) as drifts, coalesce(high, 0) as high, coalesce(drifting_fields, 0) as drifting_fields
    , coalesce(drifts, 0) > 0 as drift_detected, coalesce(score, 0) / fields as overall_score
    , coalesce(pf, '') as population_fields, coalesce(tf, '') as type_fields
  from fields f left join sums s on f.object = s.object)"""


def full_report(t):
    return d.report(history(t), 0.05, shares(t))


@query("drift_report", sql="with " + REPORT + """
select object, fields, drifts, high, drifting_fields, drift_detected, round(overall_score, 6) as overall_score, population_fields, type_fields
from report""")
def drift_report(t):
    return rounded(full_report(t).drop("advice"), "overall_score")


@query("drift_advice", sql="with " + REPORT + """,
lines as (
  select object, 1 as i, concat('Investigate ', cast(high as varchar), ' fields with high-severity drift - may indicate upstream system changes') as advice
  from report where high > 0
  union all select object, 2, concat('Population rate changes detected in fields: [', population_fields, '] - check for data completeness issues')
  from report where population_fields <> ''
  union all select object, 3, concat('Type distribution changes detected in fields: [', type_fields, '] - verify data transformation logic')
  from report where type_fields <> ''
  union all select object, 4, 'Widespread drift detected - consider reviewing connector configuration and source system changes'
  from report where drifting_fields * 2 > fields)
select object, cast(i as int) as position, advice from (
  select object, advice, row_number() over (partition by object order by i) as i from lines)""")
def drift_advice(t):
    return full_report(t).select("object", F.posexplode("advice").alias("i", "advice")).select(
        "object", (F.col("i") + 1).cast("int").alias("position"), "advice")


@query("drift_alerts", sql="with " + REPORT + """
select 'drift_detected' as type, object as object_name
  , case when overall_score > 0.7 then 'high' when overall_score > 0.4 then 'medium' else 'low' end as severity
  , round(overall_score, 6) as actual_value
from report where drift_detected""")
def drift_alerts(t):
    none = full_report(t).select(
        F.lit("").alias("object"), F.lit(0).alias("processed_records"), F.lit(0.0).alias("error_rate")).where("false")
    out = validation_alerts(none, "object", 0.1, drift=full_report(t))
    return rounded(out.select("type", "object_name", "severity", "actual_value"), "actual_value")
