"""Pipeline metrics and health scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import health as h
from lakewarden.plans.registry import query
from lakewarden.plans.validation import rounded

AS_OF = "2024-01-31 00:00:00"

COMMITS = """
commits as (
  select o_orderpriority as "table", o_orderdate as ts, count(*) as files
    , cast(sum(floor(o_totalprice)) as bigint) as size, epoch_us(o_orderdate) // 86400000000 as version
  from orders group by 1, 2)"""


def commits(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("table"), F.col("o_orderdate").alias("ts")).agg(
        F.count("*").alias("files"), F.sum(F.floor("o_totalprice")).alias("size")
    ).withColumn("version", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400))


@query("table_commits", sql="with " + COMMITS + """,
m as (
  select "table", count(*) as commits, max(version) as version, max_by(files, version) as files, max_by(size, version) as size
    , max(ts) as last_commit, cast(sum(files) as bigint) as total_files, cast(sum(size) as bigint) as total_size
  from commits group by 1),
before as (
  select "table", ts as prev from commits qualify row_number() over (partition by "table" order by version desc) = 2)
select m."table", commits, version, files, size, last_commit, total_files, total_size
  , round(1 / ((epoch_us(last_commit) - epoch_us(prev)) / 3.6e9), 9) as commits_per_hour
from m join before b on m."table" = b."table" """)
def table_commits(t):
    return rounded(h.commit_metrics(commits(t)), "commits_per_hour", places=9)


@query("table_commit_totals", sql="with " + COMMITS + """
select count(distinct "table") as tables, count(*) as commits, cast(sum(files) as bigint) as active_files
  , cast(sum(size) as bigint) as total_size from commits""")
def table_commit_totals(t):
    return h.commit_totals(h.commit_metrics(commits(t)))


@query("ckpt_health", sql="""
with m as (
  select user_id, count(*) filter (event_type = 'purchase') as created, count(*) filter (event_type = 'click') as valid
    , count(*) filter (event_type = 'error') as invalid
    , (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(max(ts) filter (event_type = 'purchase'))) / 3.6e9 as hours
  from events group by 1)
select user_id, created, valid, invalid, round(case when created = 0 then 50.0 else least(100, greatest(0,
    100 - 30.0 * coalesce(invalid / nullif(valid + invalid, 0), 0) - least(20, greatest(0, (hours - 24) * 2)))) end, 6) as score
from m""")
def ckpt_health(t):
    kind = F.when(F.col("event_type") == "purchase", "created").when(F.col("event_type") == "click", "valid").when(
        F.col("event_type") == "error", "invalid")
    log = t.events.select("user_id", "ts", kind.alias("kind"))
    return rounded(h.checkpoint_health(log, ["user_id"], AS_OF), "score")


def attempts(t):
    return t.events.select(F.col("event_type").alias("operation"), "ts", (F.col("event_id") % 7 != 0).alias("success"),
                           F.col("value").alias("delay"))


RETRIES = """
retries as (
  select event_type as operation, count(*) as attempts, count(*) filter (event_id % 7 <> 0) as successful
    , count(*) filter (event_id % 7 = 0) as failed, sum(value) as total_delay, min(value) as min_delay, max(value) as max_delay
    , avg(value) as average_delay, count(*) filter (event_id % 7 <> 0) / count(*) as success_rate, max(ts) as last_attempt
  from events group by rollup (event_type))"""


@query("retry_metrics", sql="with " + RETRIES + """
select operation, attempts, successful, failed, round(total_delay, 2) as total_delay, min_delay, max_delay
  , round(average_delay, 9) as average_delay, round(success_rate, 6) as success_rate, last_attempt from retries""")
def retry_metrics(t):
    out = rounded(h.retry_metrics(attempts(t)), "total_delay", places=2)
    return rounded(rounded(out, "average_delay", places=9), "success_rate")


BREAKERS = """
states as (
  select user_id, ts, event_id, event_id % 5 <> 0 as success
    , case event_type when 'error' then 'OPEN' when 'signup' then 'HALF_OPEN' else 'CLOSED' end as state from events),
prev as (select *, lag(state) over (partition by user_id order by ts, event_id) as p from states),
changes as (select *, lead(ts) over (partition by user_id order by ts, event_id) as next_change from prev where p is not null and p <> state),
opened as (
  select user_id, count(*) as transitions, count(*) filter (state = 'OPEN') as open_count
    , count(*) filter (state = 'HALF_OPEN') as half_open_count, max(ts) as last_change
    , sum(epoch_us(coalesce(next_change, timestamp '2024-01-31 00:00:00')) - epoch_us(ts)) filter (state = 'OPEN') / 1e6 as open_seconds
  from changes group by 1),
breakers as (
  select s.user_id, max_by(s.state, s.ts) as state, count(*) as requests, count(*) filter (success) as successes
    , count(*) filter (not success) as failures, coalesce(any_value(transitions), 0) as transitions
    , coalesce(any_value(open_count), 0) as open_count, coalesce(any_value(half_open_count), 0) as half_open_count
    , coalesce(any_value(open_seconds), 0) as open_seconds, any_value(last_change) as last_change
  from states s left join opened o on s.user_id = o.user_id group by 1)"""


def breakers(t):
    state = F.when(F.col("event_type") == "error", "OPEN").when(F.col("event_type") == "signup", "HALF_OPEN").otherwise("CLOSED")
    log = t.events.select("user_id", "ts", "event_id", state.alias("state"), (F.col("event_id") % 5 != 0).alias("success"))
    return h.breaker_metrics(log, "user_id", "event_id", AS_OF)


@query("state_changes", sql="with " + BREAKERS + """
select user_id, state, requests, successes, failures, round(successes / requests, 6) as success_rate, transitions
  , open_count, half_open_count, round(open_seconds, 3) as open_seconds, last_change from breakers""")
def state_changes(t):
    return rounded(rounded(breakers(t), "success_rate"), "open_seconds", places=3)


VERDICT = RETRIES + "," + BREAKERS + """,
sums as (
  select max(attempts) filter (operation is null) as attempts, max(success_rate) filter (operation is null) as success_rate
    , count(operation) as operations, count(*) filter (operation is not null and attempts > 5 and success_rate < 0.8) as weak
    , count(*) filter (operation is not null and attempts > 10 and success_rate < 0.8) as failing
    , max(last_attempt) as last_update from retries),
worst as (
  select coalesce(string_agg(operation, ', ' order by success_rate, operation), '') as few from (
    select * from retries where operation is not null and attempts > 10 and success_rate < 0.8 order by success_rate, operation limit 3)),
opens as (select count(*) as breakers, count(*) filter (state = 'OPEN') as open_breakers from breakers)"""


@query("retry_health_score", sql="with " + VERDICT + """
select attempts, round(success_rate, 6) as success_rate, breakers, open_breakers, weak, round(least(100, greatest(0, 100
    - case when attempts > 10 then (1 - success_rate) * 40 else 0 end - open_breakers / breakers * 30.0 - weak / operations * 20.0
    - least(10, greatest(0, ((epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_update)) / 3.6e9 - 1) * 2)))), 6) as score
from sums, opens""")
def retry_health_score(t):
    return rounded(h.retry_health_score(h.retry_metrics(attempts(t)), breakers(t), AS_OF), "success_rate", "score")


@query("retry_health", sql="with " + VERDICT + """
select success_rate >= 0.9 and open_breakers = 0 and failing = 0 as healthy, round(success_rate, 6) as success_rate, breakers, open_breakers
  , failing as failing_operations, few as worst_operations, concat_ws('; '
    , case when open_breakers > 0 then 'Investigate services with open circuit breakers' end
    , case when failing > 0 then 'Review retry policies for high failure rate operations' end
    , case when success_rate < 0.9 then 'Overall success rate is below 90%, consider system health review' end) as actions
from sums, opens, worst""")
def retry_health(t):
    return rounded(h.retry_health(h.retry_metrics(attempts(t)), breakers(t), worst=3), "success_rate")


def runs(t):
    return t.events.select("event_id", "ts", "event_type", "user_id", F.col("value").alias("duration"),
                           (F.col("event_type") != "error").alias("success"))


@query("sync_metrics", sql="""
select user_id, count(*) as runs, count(*) filter (event_type <> 'error') as successful, count(*) filter (event_type = 'error') as failed
  , round(count(*) filter (event_type <> 'error') / count(*), 6) as success_rate, max_by(value, ts) as last_duration, max(ts) as last_time
from events group by 1""")
def sync_metrics(t):
    return rounded(h.run_metrics(runs(t), ["user_id"], "event_id"), "success_rate")


@query("call_metrics", sql="""
select concat(cast(user_id as varchar), '.', event_type) as call, count(*) as calls, count(*) filter (event_type = 'error') as failures
  , max_by(value, ts) as last_duration, max(ts) as last_time
from events group by 1""")
def call_metrics(t):
    return h.call_metrics(runs(t), ["user_id", "event_type"], "event_id")


@query("http_metrics", views=("recordings",), sql="""
select 'request' as kind, concat(upper(method), ' ', replace(url, 'https://api.example.com', '')) as key, count(*) as n
  , max_by(duration_ms, request_id) as last_duration
from recordings group by 2
union all
select 'status', cast(status as varchar), count(*), null from recordings group by 2""")
def http_metrics(t):
    requests = t.recordings.select("request_id", "method", F.parse_url("url", F.lit("PATH")).alias("path"), "status",
                                   F.col("duration_ms").alias("duration"))
    return h.http_metrics(requests, "request_id")


@query("volume_totals", sql="""
select source, count(*) as records, cast(sum(octet_length(encode(text))) as bigint) as bytes, count(*) filter (lang <> 'en') as schema_changes
from documents group by 1""")
def volume_totals(t):
    return h.volume_totals(t.documents, "source", F.octet_length("text"), F.col("lang") != "en")
