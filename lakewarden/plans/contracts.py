"""API conformance queries over calls recorded from the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import contract_tables as ct, contracts as c
from lakewarden.operators.contracts import Endpoint
from lakewarden.plans.registry import query

BODY = {
    "type": "object", "required": ["k", "name"],
    "properties": {
        "k": {"type": "integer", "minimum": 10, "maximum": 90},
        "kind": {"type": "string", "enum": ["click", "view", "error"], "minLength": 5, "pattern": "^[a-z]+$"},
        "tags": {"type": "array", "items": {"type": "string", "maxLength": 1}},
    },
}
ENDPOINTS = (
    Endpoint("GET", "/click", {200: BODY}, {"content-type": "json", "x-trace": ""}, 3000),
    Endpoint("GET", "/view", {200: None, 500: None}, {"content-type": ""}, 0),
    Endpoint("POST", "/view/detail", {200: BODY}, {}, 2000),
    Endpoint("GET", "/detail", {200: None}, {"x-trace": "on"}, 1000),
    Endpoint("POST", "/error", {200: None}, {}, 1000),
)


def recordings(t):
    k = F.get_json_object("body", "$.k").cast("long")
    i = F.col("request_id")
    kind = F.regexp_extract("url", "example.com/([a-z]+)", 1)
    tags = F.when(i % 4 == 0, F.lit('"a", "bb"')).when(i % 4 == 1, F.lit('"a", 7')).otherwise(F.lit('"a"'))
    name = F.when(i % 6 == 0, F.lit("")).otherwise(F.concat(F.lit(', "name": "n'), i.cast("string"), F.lit('"')))
    body = F.concat(F.lit('{"k": '), F.when(i % 9 == 0, F.concat(F.lit('"'), k.cast("string"), F.lit('"')))
                    .otherwise(k.cast("string")), F.lit(', "kind": "'), kind, F.lit('", "tags": ['), tags, F.lit("]"),
                    name, F.lit(', "more": true}'))
    headers = F.map_concat(
        F.create_map(F.lit("content-type"), F.when(i % 10 == 0, "text").otherwise(F.lit("json")), F.lit("Authorization"), F.lit("secret")),
        F.when(i % 3 != 1, F.create_map(F.lit("x-trace"), F.lit("on"))).otherwise(F.create_map().cast("map<string,string>")))
    return t.recordings.withColumn("body", body).withColumn("headers", headers)


# The same calls and the longest matching endpoint of each.
MATCHED = """
ep(method, path, timeout_ms) as (values ('GET', '/click', 3000), ('GET', '/view', 0), ('POST', '/view/detail', 2000), ('GET', '/detail', 1000), ('POST', '/error', 1000)),
rec as (
  select *, regexp_extract(url, 'example.com/([a-z]+)', 1) as kind, cast(json_extract(body, '$.k') as bigint) as k from recordings),
matched as (
  select r.*, e.method || ' ' || e.path as endpoint, e.timeout_ms
  from rec r left join ep e on upper(r.method) = e.method and ends_with(r.url, e.path)
  qualify row_number() over (partition by r.request_id order by length(e.path) desc) = 1)"""
STATUS = """
status_v as (
  select request_id, 'status_code' as type, '' as field, 'high' as severity, 'unexpected status code' as description
  from matched where endpoint is not null and status <> 200 and not (endpoint = 'GET /view' and status = 500))"""
HEADERS = """
want(endpoint, field, value) as (values ('GET /click', 'content-type', 'json'), ('GET /click', 'x-trace', ''), ('GET /view', 'content-type', ''), ('GET /detail', 'x-trace', 'on')),
got as (
  select request_id, 'content-type' as field, case when request_id % 10 = 0 then 'text' else 'json' end as value from recordings
  union all select request_id, 'x-trace', 'on' from recordings where request_id % 3 <> 1),
header_v as (
  select m.request_id, 'headers' as type, w.field, 'medium' as severity
    , case when g.value is null then 'expected header ' || w.field || ' is missing' else 'header ' || w.field || ' value mismatch' end as description
  from matched m join want w on m.endpoint = w.endpoint left join got g on g.request_id = m.request_id and g.field = w.field
  where g.value is null or (w.value <> '' and w.value <> g.value))"""
TIMEOUT = """
timeout_v as (
  select request_id, 'timeout' as type, '' as field, 'medium' as severity, 'response time exceeded timeout threshold' as description
  from matched where timeout_ms > 0 and duration_ms > timeout_ms + 5000)"""
SCHEMA = """
bodies as (select * from matched where endpoint in ('GET /click', 'POST /view/detail') and status = 200),
schema_v as (
  select request_id, 'schema' as type, 'name' as field, 'high' as severity, 'required property is missing' as description from bodies where request_id % 6 = 0
  union all select request_id, 'schema', 'k', 'medium', 'type mismatch' from bodies where request_id % 9 = 0
  union all select request_id, 'schema', 'k', 'medium', 'number below minimum' from bodies where request_id % 9 <> 0 and k < 10
  union all select request_id, 'schema', 'k', 'medium', 'number above maximum' from bodies where request_id % 9 <> 0 and k > 90
  union all select request_id, 'schema', 'kind', 'medium', 'value not in enum' from bodies where kind not in ('click', 'view', 'error')
  union all select request_id, 'schema', 'kind', 'medium', 'string too short' from bodies where length(kind) < 5
  union all select request_id, 'schema', 'tags[1]', 'medium', 'string too long' from bodies where request_id % 4 = 0
  union all select request_id, 'schema', 'tags[1]', 'medium', 'type mismatch' from bodies where request_id % 4 = 1
  union all select request_id, 'schema', 'more', 'low', 'unexpected property' from bodies
  union all select request_id, 'schema', 'name', 'low', 'unexpected property' from bodies where request_id % 6 <> 0)"""
VIEWS = ("recordings",)


@query("contract_match", views=VIEWS, sql="with " + MATCHED + " select request_id, url, endpoint from matched")
def contract_match(t):
    return c.matched(t.recordings, ENDPOINTS).select("request_id", "url", "endpoint")


def checked(t, check):
    return c.violations_of(c.matched(recordings(t), ENDPOINTS), ["request_id"], check)


@query("contract_status", views=VIEWS, sql="with " + MATCHED + "," + STATUS + " select * from status_v")
def contract_status(t):
    return checked(t, c.status_check(ENDPOINTS))


@query("contract_headers", views=VIEWS, sql="with " + MATCHED + "," + HEADERS + " select * from header_v")
def contract_headers(t):
    return checked(t, c.header_check(ENDPOINTS))


@query("contract_timeout", views=VIEWS, sql="with " + MATCHED + "," + TIMEOUT + " select * from timeout_v")
def contract_timeout(t):
    return checked(t, c.timeout_check(ENDPOINTS))


@query("contract_schema", views=VIEWS, sql="with " + MATCHED + "," + SCHEMA + " select * from schema_v")
def contract_schema(t):
    return checked(t, c.body_check(ENDPOINTS, strict=True))


@query("contract_report", views=VIEWS, sql="with " + MATCHED + "," + STATUS + "," + HEADERS + "," + TIMEOUT + "," + SCHEMA + """,
v as (
  select request_id, severity from status_v union all select request_id, severity from header_v
  union all select request_id, severity from timeout_v union all select request_id, severity from schema_v
  union all select request_id, 'critical' from matched where endpoint is null),
n as (select request_id, count(*) as n, count(*) filter (severity in ('high', 'critical')) as hard from v group by 1)
select m.request_id, endpoint, coalesce(n, 0) as violations, coalesce(hard, 0) = 0 as success
from matched m left join n on m.request_id = n.request_id""")
def contract_report(t):
    return c.conformance(recordings(t), ENDPOINTS, strict=True).select(
        "request_id", "endpoint", F.size("violations").cast("long").alias("violations"), "success")


@query("recording_filter", views=VIEWS, sql="""
select request_id, url from recordings where ends_with(url, '/detail') or ends_with(url, '/click')""")
def recording_filter(t):
    kept = c.keep_recordings(t.recordings, [
        ("https://api.example.com", ["/detail", "/click"]), ("https://other.example.org", ())])
    return kept.select("request_id", "url")


@query("header_redact", views=VIEWS, sql="""
select request_id, 'content-type' as name, case when request_id % 10 = 0 then 'text' else 'json' end as value from recordings
union all
select request_id, 'x-trace', 'on' from recordings where request_id % 3 <> 1""")
def header_redact(t):
    return c.redact_headers(recordings(t)).select("request_id", F.explode("headers").alias("name", "value"))


# The same contract as a table: an endpoint per part.
TABLES = ("part_calls", "part_endpoints")
BY_TABLE = """
ep as (
  select upper(method) as m, path, max((timeout_ms, grade)) as terms from part_endpoints group by 1, 2),
best as (
  select c.m, c.url, e.m || ' ' || e.path as endpoint, e.terms
  from (select distinct upper(method) as m, url from part_calls) c join ep e on c.m = e.m and ends_with(c.url, e.path)
  qualify row_number() over (partition by c.m, c.url order by length(e.path) desc) = 1),
tabled as (
  select r.*, b.endpoint, b.terms[1] as timeout_ms, b.terms[2] as grade from part_calls r left join best b on upper(r.method) = b.m and r.url = b.url)"""


def part_endpoints(t):
    """Statuses and headers follow from the grade; timeout_ms is 100 times the grade."""
    grade = F.col("grade")
    statuses = F.when(grade % 5 == 0, F.array().cast("array<int>")).when(grade % 2 == 0, F.array(F.lit(200))).otherwise(F.array(F.lit(200), F.lit(500)))
    headers = F.when(grade % 4 == 0, F.create_map(F.lit("content-type"), F.lit("json"))).when(grade % 4 == 1, F.create_map(F.lit("x-trace"), F.lit("")))
    return t.part_endpoints.select("method", "path", "timeout_ms", statuses.alias("statuses"), headers.alias("headers"))


def part_calls(t):
    i = F.col("request_id")
    kind = F.create_map(F.lit("content-type"), F.when(i % 10 == 0, "text").otherwise(F.lit("json")))
    return t.part_calls.withColumn("headers", F.when(i % 3 == 1, kind).otherwise(F.map_concat(kind, F.create_map(F.lit("x-trace"), F.lit("on")))))


@query("contract_match_table", views=TABLES, sql="with " + BY_TABLE + " select request_id, url, endpoint from tabled")
def contract_match_table(t):
    return ct.matched(t.part_calls, part_endpoints(t)).select("request_id", "url", "endpoint")


@query("contract_report_table", views=TABLES, sql="with " + BY_TABLE + """,
v as (
  select request_id, endpoint, 'connectivity' as type, '' as field, 'critical' as severity from tabled where endpoint is null
  union all select request_id, endpoint, 'status_code', '', 'high' from tabled
  where grade % 5 = 0 or (grade % 2 = 0 and status <> 200)
  union all select request_id, endpoint, 'timeout', '', 'medium' from tabled where duration_ms > timeout_ms + 5000
  union all select request_id, endpoint, 'headers', 'content-type', 'medium' from tabled where grade % 4 = 0 and request_id % 10 = 0
  union all select request_id, endpoint, 'headers', 'x-trace', 'medium' from tabled where grade % 4 = 1 and request_id % 3 = 1)
select * from v""")
def contract_report_table(t):
    return ct.conformance(part_calls(t), part_endpoints(t)).select("request_id", "endpoint", F.inline("violations")).drop("description")


@query("recording_filter_table", views=TABLES, sql="""
with wanted as (
  select distinct path from part_endpoints where upper(method) = 'GET')
select request_id, url from part_calls
where url in (select c.url from (select distinct url from part_calls) c join wanted w on ends_with(c.url, w.path))""")
def recording_filter_table(t):
    filters = t.part_endpoints.where("upper(method) = 'GET'").select(F.lit("https://api").alias("base"), F.col("path").alias("ending"))
    return ct.keep_recordings(t.part_calls, filters).select("request_id", "url")
