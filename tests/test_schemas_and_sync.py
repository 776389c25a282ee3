"""Schemas, sync decisions, state and consistency."""

from datetime import datetime, timedelta

import pytest

from conftest import as_set
from lakewarden.operators import consistency as c, schemas as s, sync
from lakewarden.operators.rules import Field
from lakewarden.sources import extracts

FIELDS = "object string, name string, type string"
NOW = datetime(2024, 1, 31)


def test_fingerprint_is_known_and_ignores_order(rows):
    a = rows([("o", "Id", "string"), ("o", "Amount", "double")], FIELDS)
    b = rows([("o", "Amount", "double"), ("o", "Id", "string")], FIELDS)
    other = rows([("o", "Amount", "long"), ("o", "Id", "string")], FIELDS)
    hashes = [s.fingerprint(x).first().schema_hash for x in (a, b, other)]
    assert hashes[0] == hashes[1] == "bc62ebc4c1e181ea" != hashes[2]


@pytest.mark.parametrize("after, want", [
    ([("a", "string")], "none"), ([("a", "string"), ("b", "long")], "additive"), ([], "breaking"),
    ([("a", "long")], "breaking"), ([("a", "long"), ("b", "long")], "breaking"),
])
def test_classes(rows, after, want):
    before = rows([("o", "a", "string")], FIELDS)
    now = rows([("o", *f) for f in after], FIELDS)
    assert s.classify(before, now).first().classification == want


def test_diff_of_itself_is_empty(rows):
    x = rows([("o", "a", "string"), ("o", "b", "long")], FIELDS)
    assert s.diff(x, x).count() == 0


def test_history_only_moves_on_change(rows):
    snaps = rows([("o", 1, "a", "string"), ("o", 2, "a", "string"), ("o", 3, "a", "long"), ("o", 4, "a", "string")],
                 "object string, taken int, name string, type string")
    assert as_set(s.history(snaps, "taken").select("taken", "version")) == {(1, 1), (3, 2), (4, 3)}


def test_conform_adds_missing_columns(rows):
    out = s.conform(rows([("1",)], "a string"), [Field("a", "long"), Field("b", "string")])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [("a", "bigint"), ("b", "string")]
    assert out.first() == (1, None)


def test_five_plan_cases(rows):
    now = rows([(o, "Id", "string") for o in "abcde"] + [("b", "New", "string")], FIELDS)
    previous = rows([("a", "Id", "string"), ("b", "Id", "string"), ("c", "Id", "string"), ("c", "Old", "string")], FIELDS)
    same = s.fingerprint(now).where("object = 'a'").first().schema_hash
    state = rows([("a", same, 1), ("b", "x", 1), ("c", "x", 3), ("d", "x", 2)], "object string, schema_hash string, schema_version int")
    catalog = rows([(o,) for o in "abcdef"], "object string")
    allowed = rows([(o,) for o in "abcde"], "object string")
    got = {r.object: (r.mode, r.schema_changed, r.new_version) for r in sync.plan(catalog, now, state, previous, allowed).collect()}
    assert got == {"a": ("incremental", False, 1), "b": ("incremental", True, 2), "c": ("full", True, 4),
                   "d": ("full", True, 3), "e": ("full", False, 1), "f": ("skip", False, None)}


def state_of(rows, **ages):
    return rows([(o, NOW - timedelta(hours=sync_h), NOW - timedelta(hours=wm_h)) for o, (sync_h, wm_h) in ages.items()],
                "object string, last_sync timestamp_ntz, watermark timestamp_ntz")


@pytest.fixture
def edges(rows):
    return rows([("Account", "Contact"), ("Account", "Opportunity")], "parent string, dependent string")


def test_healthy(rows, edges):
    state = state_of(rows, Account=(0.1, 0.1), Contact=(0.1, 0.1), Opportunity=(0.1, 0.1))
    found = c.violations(state, edges, NOW)
    assert found.count() == 0 and c.report(found).first().status == "healthy"


def test_stale_by_three_windows(rows, edges):
    windows = rows([("Account", 3600)], "object string, max_age_s int")
    row = c.staleness(state_of(rows, Account=(3, 0)), NOW, windows).first()
    assert (row.parent, row.severity) == ("Account", "high")


def test_missing_drift_and_gap(rows, edges):
    state = state_of(rows, Account=(0, 0), Contact=(7, 4))
    assert c.missing_dependents(state, edges).first().dependent == "Opportunity"
    drift = c.watermark_drift(state, edges).first()
    assert (drift.dependent, drift.severity, drift.amount_s) == ("Contact", "low", 4 * 3600.0)
    assert c.sync_gap(state, edges).first().severity == "medium"
    assert c.report(c.violations(state, edges, NOW)).first().status == "degraded"


def test_missing_dependents_of_a_parent_count_once(rows, edges):
    found = c.violations(state_of(rows, Account=(0, 0)), edges, NOW)
    assert found.count() == 2
    report = c.report(found).first()
    assert (report.violations, report.high, report.status) == (1, 1, "degraded")


def test_watermark_is_strict_and_cut_to_milliseconds(rows):
    t = datetime(2024, 1, 1, 0, 0, 0, 123456)
    df = rows([(1, t), (2, t.replace(microsecond=123000)), (3, t.replace(microsecond=124000))], "id int, ts timestamp_ntz")
    out = extracts.incremental(df, "ts", t)
    assert [r.id for r in out.collect()] == [1, 3]


def test_watermark_filter_reaches_the_reader(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    plan = extracts.incremental(df, "ts", "2024-01-20", ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_retry_queue_waits(rows):
    failures = rows([("a", 1, NOW - timedelta(seconds=1)), ("b", 3, NOW - timedelta(seconds=30)),
                     ("c", 3, NOW - timedelta(seconds=90)), ("d", 9, NOW - timedelta(days=1))],
                    "object string, attempts int, last_attempt timestamp_ntz")
    due = sync.retry_queue(failures, NOW, base_s=30, max_s=60, max_attempts=5)
    assert as_set(due.select("object")) == {("a",), ("c",)}
