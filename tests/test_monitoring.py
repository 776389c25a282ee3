"""Drift, health rules, trends, profiling and scores."""

from datetime import datetime, timedelta

import random

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from lakewarden.operators import contracts as c, drift as d, events as e, health as h, monitoring as m, profiling as p, scanning as s
from lakewarden.operators.monitoring import HealthRule

T0 = datetime(2024, 1, 1)


def history(rows, rates, means=None):
    means = means or [None] * len(rates)
    return rows([("o", "name", T0 + timedelta(days=i), r, x) for i, (r, x) in enumerate(zip(rates, means))],
                "object string, field string, snapshot_ts timestamp_ntz, population_rate double, mean double")


def test_population_drift(rows):
    drift = d.population_drift(history(rows, [0.95, 0.90, 0.70]), 0.1, min_samples=3).first()
    assert (drift.field, drift.current_value, drift.severity) == ("name", 0.70, "medium")
    assert d.population_drift(history(rows, [0.95, 0.70]), 0.1, min_samples=3).count() == 0


def test_population_from_zero(rows):
    assert d.population_drift(history(rows, [0.0, 0.0, 0.5]), 0.1).first().severity == "high"
    assert d.population_drift(history(rows, [0.0, 0.0, 0.0]), 0.1).count() == 0


def test_mean_drift_leaves_small_means(rows):
    assert d.mean_drift(history(rows, [1.0] * 3, [10.0, 10.0, 16.0]), 0.1).first().severity == "high"
    assert d.mean_drift(history(rows, [1.0] * 3, [0.0, 0.0005, 5.0]), 0.1).count() == 0


def test_type_drift(rows):
    shares = rows([("o", "f", T0, "string", 1.0), ("o", "f", T0 + timedelta(days=1), "string", 1.0),
                   ("o", "f", T0 + timedelta(days=2), "string", 0.9), ("o", "f", T0 + timedelta(days=2), "integer", 0.1)],
                  "object string, field string, snapshot_ts timestamp_ntz, value_type string, share double")
    row = d.type_drift(shares, 0.1).first()
    assert round(row.current_value, 6) == 0.2 and row.severity in ("low", "medium")


@pytest.mark.parametrize("rate, status", [(0.05, "ok"), (0.15, "critical")])
def test_failure_rate_rule(rows, rate, status):
    metrics = rows([(T0, "failure_rate", rate)], "ts timestamp_ntz, metric string, value double")
    checked = m.check_rules(metrics, [HealthRule("agent_failure_rate", "failure_rate", critical=0.10)])
    assert checked.first().status == status
    assert m.overall_health(checked, ["ts"]).first().overall_status == status


def test_trend_direction_and_strength(rows):
    metrics = rows([(T0 + timedelta(seconds=i), "x", 2.0 * i) for i in range(10)], "ts timestamp_ntz, metric string, value double")
    row = m.trend(metrics, T0 + timedelta(seconds=10), 3600).first()
    assert (round(row.slope, 6), row.direction, row.strength) == (2.0, "increasing", "strong")
    assert m.trend(metrics.limit(1), T0 + timedelta(seconds=10), 3600).count() == 0


def test_resource_trend_keeps_the_cut_off(rows):
    mb = 1024 * 1024
    samples = rows([("r", T0 + timedelta(minutes=30 * i), (i + 1) * mb) for i in range(3)], "k string, ts timestamp_ntz, memory long")
    row = p.resource_trend(samples, ["k"], T0 + timedelta(hours=1), 7200).first()
    assert (row.peak, row.average, row.direction) == (3 * mb, 2 * mb, "stable")


def test_floor_index_percentiles(rows):
    log = rows([("a", T0 + timedelta(seconds=i), float(i), i) for i in range(1500)], "op string, ts timestamp_ntz, duration double, i long")
    row = p.percentiles(log).first()
    assert (row.p50, row.p95, row.p99) == (750.0, 1425.0, 1485.0)
    same = rows([("b", 2.0)] * 50 + [("b", None)], "op string, duration double")
    assert tuple(p.percentiles(same).first()) == ("b", 2.0, 2.0, 2.0)


def test_percentiles_under_a_far_value(rows, spark):
    """One value far off, equal ones, null operations: exact, and only what lies near a wanted rank is sorted."""
    rng = random.Random(8)
    data = [(op, round(rng.lognormvariate(0, 2), 3)) for op in ("a", None) for _ in range(20_000)] + [("a", 1e9), ("b", 1.0), ("b", 1.0), ("b", 7.0)]
    log = rows(data, "op string, duration double")
    got = {r.op: (r.p50, r.p95, r.p99) for r in p.percentiles(log, accuracy=500).collect()}
    for op in ("a", None, "b"):
        own = sorted(v for o, v in data if o == op)
        assert got[op] == tuple(own[len(own) * q // 100] for q in (50, 95, 99))
    most = p.brackets(log, ["op"], 500).groupBy("op", "__p").count().agg(F.max("count")).first()[0]
    assert most < 20_000 * 0.05


def test_no_bottleneck_is_said(rows):
    none = rows([], "type string, operation string, severity string, impact double, suggestion string")
    assert p.ranked_advice(none).first().advice == p.HEALTHY_ADVICE


def test_breaker_open_from_the_start(rows):
    def at(i):
        return T0 + timedelta(seconds=i)

    log = rows([("b", 1, at(0), "OPEN", False), ("b", 2, at(10), "CLOSED", True), ("b", 3, at(20), "OPEN", False),
                ("b", 4, at(25), "HALF_OPEN", True), ("b", 5, at(30), "OPEN", False)],
               "key string, id long, ts timestamp_ntz, state string, success boolean")
    row = h.breaker_metrics(log, "key", "id", at(40)).first()
    assert (row.transitions, row.open_count, row.half_open_count, row.open_seconds) == (4, 2, 1, 15.0)


def test_alert_from_threshold_on(rows):
    ev = rows([(i, T0 + timedelta(seconds=i), "auth_failure", "low") for i in range(5)] + [(9, T0, "file_access", "critical")],
              "event_id long, ts timestamp_ntz, type string, severity string")
    assert as_set(e.event_alerts(ev, 4).select("event_id")) == {(3,), (4,), (9,)}
    assert as_set(e.event_alerts(ev, 6).select("event_id")) == {(9,)}
    assert e.event_score(ev).first().score == 100 - 5 * 2.0 - 1.8


def test_scan_positions(rows, spark):
    docs = rows([(1, "ab token: x\n  token: y token: z ")], "doc_id int, text string")
    rules = s.usable_rules(spark, [s.ScanRule("t", r"token:", "HIGH"), s.ScanRule("bad", "([", "low")])
    got = as_set(s.scan_rules(docs, ["doc_id"], "text", rules).select("line", "column", "evidence"))
    assert got == {(1, 4, "ab token: x"), (2, 3, "token: y token: z"), (2, 12, "token: y token: z")}


def test_nested_schema(rows):
    schema = {"type": "object", "required": ["id"], "properties": {
        "id": {"type": "integer"}, "items": {"type": "array", "items": {"type": "object", "required": ["n"],
                                                                      "properties": {"n": {"type": "number", "maximum": 5}}}}}}
    calls = rows([("r", "get", "http://h/x", 200, '{"id": 1.0, "items": [{"n": 1}, {"n": 9}, {}, 3]}', 1)],
                 "request_id string, method string, url string, status int, body string, duration_ms long")
    found = c.conformance(calls, [c.Endpoint("GET", "/x", {200: schema})]).first()
    assert {(x.field, x.description) for x in found.violations} == {
        ("items[1].n", "number above maximum"), ("items[2].n", "required property is missing"), ("items[3]", "type mismatch")}
    assert not found.success


def test_longest_path_wins_and_lost_calls_are_critical(rows):
    calls = rows([(1, "GET", "http://h/a/b"), (2, "get", "http://h/b"), (3, "PUT", "http://h/b")], "request_id int, method string, url string")
    ends = [c.Endpoint("GET", "/b"), c.Endpoint("get", "/a/b")]
    assert as_set(c.matched(calls, ends).select("request_id", "endpoint")) == {(1, "GET /a/b"), (2, "GET /b"), (3, None)}


@pytest.mark.parametrize("body, fits", [
    ('{"a": 1}', "object"), (" [1]", "array"), ('"x"', "string"), ("-1.5", "number"), ("3.0", "integer"), ("true", "boolean"),
    ("null", "null"), ("not json", None), (None, None),
])
def test_root_type_of_body(rows, body, fits):
    df = rows([(1, "GET", "http://h/x", 200, body, 1)],
              "request_id int, method string, url string, status int, body string, duration_ms long")
    for want in ("object", "array", "string", "number", "integer", "boolean", "null"):
        found = c.conformance(df, [c.Endpoint("GET", "/x", {200: {"type": want}})]).first().violations
        ok = want == fits or (want == "number" and fits == "integer")
        assert (not found) == ok, (body, want)


def test_many_matches_in_one_line(rows):
    n = 100_000
    df = rows([(1, "ab " * n + "x"), (2, "x"), (3, None)], "id long, text string")
    found = s.scan_rules(df, ["id"], "text", [s.ScanRule("r", "ab", "low")])
    got = found.agg(F.count("*").alias("n"), F.min("column").alias("lo"), F.max("column").alias("hi"), F.sum("column").alias("s")).first()
    assert tuple(got) == (n, 1, 3 * n - 2, sum(range(1, 3 * n, 3)))


def many_events(spark, n):
    return spark.range(n).select(
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"), F.col("id").alias("event_id"),
        F.lit("auth_failure").alias("type"), F.lit("critical").alias("severity"))


def test_counts_cover_all_events(spark):
    events = many_events(spark, 3000)
    assert e.recent_events(events, "1970-01-01 01:00:00").count() == 2999  # the window is open at its start
    assert e.recent_events(events, "1970-01-01 01:00:00", 2500).count() == 2500
    assert e.recent_events(events, "1970-01-01 01:00:00", 0).count() == 0
    assert e.event_report(events).first().total_issues == 3000


def test_quiet_ticks_are_points_too(rows):
    events = rows([(T0, 1, "auth_failure"), (T0 + timedelta(minutes=5), 2, "auth_failure")], "ts timestamp_ntz, event_id long, type string")
    got = e.event_trend(events, T0, T0 + timedelta(minutes=6)).where("category = 'auth_failures'").orderBy("tick").collect()
    assert [r.value for r in got] == [1] * 10 + [2] * 2


def test_newest_rows_are_as_many_as_asked(spark):
    metrics = many_events(spark, 400).select("ts", F.lit("m").alias("metric"), F.lit(1.0).alias("value"))
    assert m.recent(metrics, 300).count() == 300


def test_time_filters_reach_the_reader(spark, tmp_path):
    many_events(spark, 50).select("*", F.lit("m").alias("metric"), F.lit(1.0).alias("value")).write.parquet(f"{tmp_path}/e")
    stored = spark.read.parquet(f"{tmp_path}/e")
    for df in (e.recent_events(stored, "1970-01-01 01:00:10"), m.trend(stored, "1970-01-01 01:00:10", 3600), m.window_average(stored, "1970-01-01 01:00:10", 3600)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(ts,1970-01-01T00:00:10" in plan


def test_anomalies_against_plain_windows(spark):
    rows_ = [("a", i, float((i * 37) % 11) + (50 if i == 700 else 0)) for i in range(900)] + [("b", i, 1e9 + i % 3) for i in range(50)]
    df = spark.createDataFrame(rows_, "metric string, t long, value double").withColumn("ts", F.timestamp_seconds(F.col("t") * 3600))
    got = {(r.metric, r.ts): (r.mean, r.spread) for r in m.anomalies(df, 3.0).collect()}
    values = [v for k, _, v in rows_ if k == "a"][:700]
    mean = sum(values) / 700
    spread = (sum((v - mean) ** 2 for v in values) / 700) ** 0.5
    assert list(got.values()) == [(pytest.approx(mean), pytest.approx(spread))]
