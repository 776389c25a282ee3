"""Contracts and filters given as tables, against plain loops."""

import random

from conftest import as_set
from lakewarden.operators import contract_tables as ct

CALLS = "request_id long, method string, url string, status int, duration_ms long, headers map<string,string>"


def call(i, method="GET", url="https://h/a/b", status=200, ms=10, headers=None):
    return (i, method, url, status, ms, headers)


def test_ten_thousand_endpoints(spark, rows):
    draw = random.Random(2)
    paths = [f"/v{i % 7}/things/{i}" for i in range(9000)] + [f"ings/{i}" for i in range(1000)] + ["/9"]
    ends = rows([(draw.choice(["get", "POST"]), p) for p in paths], "method string, path string")
    urls = [f"https://h{draw.randrange(3)}/v{draw.randrange(8)}/things/{draw.randrange(9999)}" for _ in range(300)] * 3
    calls = rows([call(i, draw.choice(["GET", "post"]), u) for i, u in enumerate(urls)], CALLS)
    known = {(r.method.upper(), r.path) for r in ends.collect()}
    want = {
        (c.request_id, max((f"{m} {p}" for m, p in known if m == c.method.upper() and c.url.endswith(p)), key=len, default=None))
        for c in calls.collect()
    }
    got = ct.matched(calls, ends).select("request_id", "endpoint")
    assert as_set(got) == want and any(e for _, e in want)
    text = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_odd_endpoints_and_calls(rows):
    ends = rows(
        [("get", "/b", 100, [200]), ("GET", "/b", 50, [404]), ("GET", "", 0, None), (None, "/a/b", 1, [200]), ("POST", None, 1, [200])],
        "method string, path string, timeout_ms long, statuses array<int>")
    calls = rows([call(1), call(2, url="x"), call(3, "POST"), call(4, None), call(5, url=None), call(6, status=404, ms=5101)], CALLS)
    got = {r.request_id: (r.endpoint, sorted(v.type for v in r.violations), r.success) for r in ct.conformance(calls, ends).collect()}
    lost = (None, ["connectivity"], False)
    assert got == {
        1: ("GET /b", [], True), 2: ("GET ", ["status_code"], False), 3: lost, 4: lost, 5: lost,
        6: ("GET /b", ["status_code", "timeout"], False)}
    assert as_set(ct.matched(calls, ends.limit(0)).select("endpoint")) == {(None,)}
    assert ct.matched(calls.limit(0), ends).count() == 0
    assert as_set(ct.matched(calls.withColumn("endpoint", calls.url), ends).select("request_id", "endpoint").where("request_id = 1")) == {(1, "GET /b")}


def test_headers_by_table(rows):
    ends = rows([("GET", "/b", [200], {"type": "json", "trace": ""})], "method string, path string, statuses array<int>, headers map<string,string>")
    calls = rows([call(1, headers={"type": "json", "trace": "x"}), call(2, headers={"type": "text"}), call(3)], CALLS)
    got = ct.conformance(calls, ends).selectExpr("request_id", "inline(violations)").select("request_id", "field", "description")
    assert as_set(got) == {
        (2, "type", "header type value mismatch"), (2, "trace", "expected header trace is missing"),
        (3, "type", "expected header type is missing"), (3, "trace", "expected header trace is missing")}


def test_filters_by_table(rows):
    filters = [("https://a", "/x"), ("https://b.example", None), (None, "y"), ("http", "/x/z")]
    urls = ["https://a.example/x", "https://a/q", "https://b.example/anything?u=/x", "ftp://c/y", "https://c/x/z", "https://c/x", None, "not a url", "https://a.example/x"]
    calls = rows([call(i, url=u) for i, u in enumerate(urls)], CALLS)
    table = rows(filters, "base string, ending string")
    assert as_set(ct.keep_recordings(calls, table).select("request_id")) == {(0,), (2,), (3,), (4,), (8,)}
    assert ct.keep_recordings(calls, table).columns == calls.columns
    for every in (table.limit(0), rows([(None, "")], "base string, ending string")):
        assert ct.keep_recordings(calls, every).count() == len(urls)
