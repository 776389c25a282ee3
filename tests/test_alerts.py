"""Cooldown: against a plain loop, with hot rules cut into stretches, in batch and on a stream."""

import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import as_set
from lakewarden.operators import alerts as batch_alerts
from lakewarden.operators.alerts import alert_history, cooldown
from lakewarden.session import fresh_dir
from lakewarden.streaming import alerts as live, rates
from lakewarden.streaming.ingest import read_stream


def by_loop(data, wait):
    last, sent = {}, set()
    for i, rule, t in sorted(data, key=lambda r: (r[2], r[0])):
        if rule not in last or t - last[rule] >= wait:
            last[rule] = t
            sent.add(i)
    return sent


def frame(spark, data):
    return spark.createDataFrame(data, "id long, rule string, t long").withColumn("ts", F.timestamp_seconds("t"))


@pytest.mark.parametrize("seed, wait, pieces, span", [
    (1, 1800, 5, 86400), (2, 1800, 32, 86400), (4, 3600, None, 30 * 86400), (5, 50, 17, 2000), (6, 1800, 9, 1000),
])
def test_same_as_loop(spark, seed, wait, pieces, span):
    rng = random.Random(seed)
    data = [(i, "hot" if rng.random() < 0.7 else f"r{rng.randrange(5)}", 1_700_000_000 + rng.randrange(span)) for i in range(3000)]
    sent = cooldown(frame(spark, data), "rule", "ts", "id", wait, pieces)
    assert {r.id for r in sent.select("id").collect()} == by_loop(data, wait)


def test_second_dropped_third_sent(spark):
    data = [(1, "a", 0), (2, "a", 60), (3, "a", 1800)]
    sent = cooldown(frame(spark, data), "rule", "ts", "id")
    assert {r.id for r in sent.collect()} == {1, 3}
    assert alert_history(sent, "rule", "ts").first().sent == 2


def test_equal_times_send_once(spark):
    data = [(i, "a", 100) for i in range(10)]
    assert [r.id for r in cooldown(frame(spark, data), "rule", "ts", "id").collect()] == [0]


def test_stream_equals_batch(spark):
    rng = random.Random(11)
    data = [(i, f"r{rng.randrange(4)}", 1_700_000_000 + i * 120 + rng.randrange(100)) for i in range(900)]
    df = frame(spark, data).drop("t")
    root = fresh_dir(spark, "test-cooldown")
    for part in range(3):
        df.where(F.col("id").between(part * 300, part * 300 + 299)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    rates.drain(live.cooldown_stream(read_stream(spark, f"{root}/in", df), "rule", "ts", "id", 1800), f"{root}/out", f"{root}/cp")
    batch = cooldown(df, "rule", "ts", "id", 1800)
    assert as_set(spark.read.parquet(f"{root}/out").select("id")) == as_set(batch.select("id"))


def largest_task(df, keys):
    """Rows of the largest group that a step by these keys puts into one task."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("span", [1000, 10**9])
def test_a_burst_is_spread(spark, monkeypatch, span):
    """All alerts of a rule within one cooldown, or even a thousandth of it, reach no task together."""
    seen = []

    def settled(df, name):
        out = real(df, name)
        if "__piece" in out.columns:
            seen.append((name, largest_task(out, ["__piece"]), out.count()))
        return out

    real = batch_alerts.settled
    monkeypatch.setattr(batch_alerts, "settled", settled)
    rows = spark.range(20_000).select("id", F.lit("a").alias("rule"), F.timestamp_micros((F.col("id") * 7919) % span + 10**15).alias("ts"))
    sent = cooldown(rows, "rule", "ts", "id", 1800, 20).collect()
    first = rows.orderBy("ts", "id").first()
    assert [r.id for r in sent] == [first.id]
    assert {n for n, _, _ in seen} == {"alerts", "alert-order"}
    assert all(most <= max(3 * n / 20, 60) for _, most, n in seen)


def test_rounds_grow_with_the_logarithm_of_the_pieces(spark, monkeypatch):
    names = []
    real = batch_alerts.settled
    monkeypatch.setattr(batch_alerts, "settled", lambda df, name: (names.append(name), real(df, name))[1])
    data = [(i, "a", 60 * i) for i in range(20_000)]
    sent = cooldown(frame(spark, data), "rule", "ts", "id", 1800, 64)
    assert {r.id for r in sent.select("id").collect()} == by_loop(data, 1800)
    assert names.count("alert-leads") <= 8


def test_alerts_without_rule_time_or_tie_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "a", None), (None, "a", 1), (3, "a", 1), (3, "a", 1), (4, "b", 2)], "id long, rule string, t long")
    got = cooldown(df.withColumn("ts", F.timestamp_seconds("t")), "rule", "ts", "id").collect()
    assert sorted(r.id for r in got) == [3, 4]
    assert cooldown(df.withColumn("ts", F.timestamp_seconds("t")).limit(0), "rule", "ts", "id").count() == 0


@pytest.mark.parametrize("function", [batch_alerts._leave(1), batch_alerts._mark(1)])
def test_task_functions_need_no_package_on_executors(tmp_path, function):
    path = tmp_path / "function.pickle"
    path.write_bytes(cloudpickle.dumps(function))
    code = (f"import pickle, sys; from pyspark import TaskContext; TaskContext.get = staticmethod(lambda: type('T', (), {{'partitionId': lambda s: 0}})()); "
            f"f = pickle.load(open({str(path)!r}, 'rb')); "
            "assert list(f(iter([]))) == [] and not any(m.startswith('lakewarden') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
