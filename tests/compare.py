"""Run a registered query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from lakewarden.plans import oracles, queries
from lakewarden.plans.tables import NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """Value as a (kind, text) pair, so 1 and 1.0, or a date and its text, count as different."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, (float, decimal.Decimal)):
        return ("float", repr(float(value) + 0.0))
    if isinstance(value, dt.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", str([plain(v) for v in value]))
    return (type(value).__name__, str(value))


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows])


NO_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def run_spark(spark, name, sf_dir):
    df = queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [p for p in NO_PAIRS if p in plan]
    if found:
        raise AssertionError(f"{name} pairs all rows: {found}")
    return df.columns, rows


def run_sql(con, name):
    rel = con.execute(oracles()[name])
    columns = [d[0] for d in rel.description]
    return columns, rel.fetchall()


def difference(spark, con, name, sf_dir) -> str | None:
    """None when both sides agree, else what differs."""
    got_cols, got = run_spark(spark, name, sf_dir)
    if name not in oracles():
        return None if got else "no rows"
    want_cols, want = run_sql(con, name)
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} against {sorted(want_cols)}"
    left, right = canon(got, got_cols), canon(want, want_cols)
    if left == right:
        return None if left else "both empty"
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return f"rows {len(left)} against {len(right)}\n  spark {only_left}\n  sql   {only_right}"
