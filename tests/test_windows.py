"""The skew-safe building blocks against plain windows, with one key holding most rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from conftest import as_set
from lakewarden.functions.windows import newest_per_key, running_sum, with_previous


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(4000):
        key = "hot" if rng.random() < 0.7 else f"k{rng.randrange(20)}"
        data.append((i, key, 1_700_000_000 + rng.randrange(20 * 86400), rng.choice("abc"), rng.randrange(10)))
    df = spark.createDataFrame(data, "id long, k string, t long, s string, n int")
    return df.withColumn("ts", F.timestamp_seconds("t")).cache()


def test_newest_per_key(skewed):
    order = [F.col("ts").desc(), F.col("id").desc()]
    plain = skewed.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where("r <= 7")
    mine = newest_per_key(skewed, ["k"], order, 7, spread_by=["id"], rank="r")
    assert as_set(mine.select("k", "id", "r")) == as_set(plain.select("k", "id", "r"))


@pytest.mark.parametrize("burst", [False, True])
@pytest.mark.parametrize("pieces", [None, 1, 40])
def test_with_previous(skewed, pieces, burst):
    holes = skewed.withColumn("k", F.when(F.col("k") != "k3", F.col("k")))
    if burst:  # all rows of a key in one second
        holes = holes.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000)))
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = holes.withColumn("p", F.lag("s").over(w))
    mine = with_previous(holes, ["k"], "ts", "id", ["s"], "prev", pieces).withColumn("p", F.col("prev.s"))
    assert as_set(mine.select("id", "p")) == as_set(plain.select("id", "p"))


def test_running_sum(skewed):
    ticks = skewed.groupBy("k", "ts").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("k").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    plain = ticks.withColumn("n", F.sum("n").over(w))
    assert as_set(running_sum(ticks, ["k"], "ts", ["n"]).select("k", "ts", "n")) == as_set(plain.select("k", "ts", "n"))


def test_a_burst_of_one_key_is_dealt_out(spark):
    df = spark.range(4000).select("id", F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(5)).alias("ts"))
    dealt = df.repartitionByRange(8, "k", "ts", "id").groupBy(F.spark_partition_id().alias("p")).count()
    assert dealt.agg(F.max("count")).first()[0] < 1500
    got = with_previous(df, ["k"], "ts", "id", ["id"], "prev", 8).select("id", F.col("prev.id").alias("p"))
    assert as_set(got) == {(i, i - 1 if i else None) for i in range(4000)}


@pytest.mark.parametrize("spread", [1, 10**6])
def test_running_sum_of_a_burst(spark, monkeypatch, spread):
    """All rows of a key within a second: added up in many pieces, none with much of it."""
    from lakewarden.functions import windows

    seen = []
    real = windows.settled
    monkeypatch.setattr(windows, "settled", lambda df, name: (seen.append(real(df, name)), seen[-1])[1])
    df = spark.range(8000).select("id", F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") % spread).alias("ts"), F.lit(1).alias("n"))
    got = running_sum(df, ["k"], "ts", ["n"], 16)
    assert sorted(r.n for r in got.select("n").collect()) == list(range(1, 8001))
    assert seen[0].groupBy("__piece").count().agg(F.max("count")).first()[0] < 2000
    late = got.orderBy("ts").select("ts", "n").collect()
    assert all(a.ts < b.ts for a, b in zip(late, late[1:]) if a.n > b.n) is (spread > 8000) or spread == 1
