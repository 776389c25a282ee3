"""Streaming queries over a table of several files whose order is not that of time."""

import functools

import pytest
from pyspark.sql import functions as F

from conftest import SF
from lakewarden.plans import queries
from lakewarden.operators.alerts import cooldown
from lakewarden.operators.rules import Field
from lakewarden.sources.versioned import VersionedTable
from lakewarden.streaming import alerts as live, ingest, rates


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """Events in files from late to early, some without time, in batches of about one file."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    events = events.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    cuts = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])).first()[0]
    part = sum((F.when(F.unix_micros(F.col("ts").cast("timestamp")) > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for n in (3, 1, 2, 0):
        events.where(part == n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(ingest, "BATCH_BYTES", 10_000, raising=False)
    monkeypatch.setattr(ingest, "read_stream", functools.partial(ingest.read_stream, bytes_per_batch=10_000))
    return str(tmp_path)


def test_error_rate_counts_every_event(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    want = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start"), "event_type").count().collect()
    got = queries()["stream_error_rate"](spark, folder).collect()
    assert {(r.start, r.event_type, r.n) for r in got} == {tuple(r) for r in want} and len(got) == len(want)
    assert any(r.start is None for r in got)


def test_cooldown_is_that_of_the_batch_operator(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "event_type", "ts")
    want = cooldown(events, "event_type", "ts", "event_id", 6 * 3600).collect()
    got = queries()["stream_cooldown"](spark, folder).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want} and len(got) == len(want) > 100


def test_a_crowded_rule_meets_in_no_group(spark, tmp_path, monkeypatch):
    """A batch is handed to the batch operator, which cuts rules into stretches, once for each stretch of time."""
    seen = []
    monkeypatch.setattr(live, "cooldown", lambda df, *more: seen.append(df.count()) or cooldown(df, *more), raising=False)
    data = spark.range(4000).select("id", F.lit("a").alias("rule"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    for stream in ingest.arrivals(data, "ts", 2, f"{tmp_path}/in"):
        rates.drain(live.cooldown_stream(stream, "rule", "ts", "id", 1800), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").select("id").collect())
    assert got == list(range(0, 4000, 30)) and len(seen) == 2 and sum(seen) <= 4000


def test_the_table_is_read_as_often_for_many_stretches_as_for_few(spark, tmp_path, monkeypatch):
    """Once to sample the ranges and once to write them; each stretch then reads its own folder."""
    monkeypatch.setattr(ingest, "STRETCH_TASKS", 2)
    took = {}
    for pieces in (3, 20):
        seen = spark.sparkContext.accumulator(0)

        def passing(value, seen=seen):
            seen.add(1)
            return value

        rows = spark.range(20_000, numPartitions=4).select("id", F.timestamp_seconds((F.col("id") * 7919) % 10**6).alias("ts"))
        data = rows.withColumn("id", F.udf(passing, "long")("id"))
        assert sum(1 for _ in ingest.arrivals(data, "ts", pieces, f"{tmp_path}/in{pieces}")) == pieces
        took[pieces] = seen.value
        assert spark.read.parquet(f"{tmp_path}/in{pieces}").count() == 20_000
        spans = [spark.read.parquet(f"{tmp_path}/in{pieces}-stretches/__stretch={i}").agg(F.min("ts"), F.max("ts")).first() for i in range(pieces)]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert took[20] == took[3] <= 40_000


def test_no_rows_arrive_once(spark, tmp_path):
    none = spark.range(0).select("id", F.timestamp_seconds("id").alias("ts"))
    assert len(list(ingest.arrivals(none, "ts", 3, f"{tmp_path}/in"))) == 1


def test_a_batch_is_evaluated_once_and_a_bad_one_leaves_no_version(spark, tmp_path):
    table = VersionedTable.create(spark, f"{tmp_path}/table")
    fields = (Field("id", "long", False), Field("name", "string", False))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        seen.add(1)
        return name

    good = spark.createDataFrame([(i, f"n{i}") for i in range(100)], "id long, name string")
    good.coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = ingest.read_stream(spark, f"{tmp_path}/in", good)
        ingest.ingest(stream, table, fields, f"{tmp_path}/cp", f"{tmp_path}/report", strict=True,
                      prepare=lambda rows: rows.withColumn("name", counted("name")))

    run()
    assert seen.value == 100 and table.latest() == 0 and table.read().count() == 100
    report = spark.read.parquet(f"{tmp_path}/report").first()
    assert (report.total_records, report.valid_records, report.error_records, report.null_rate) == (100, 100, 0, 0.0)
    spark.createDataFrame([(1, None)], good.schema).write.mode("append").parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="batch 1 has errors"):
        run()
    assert table.latest() == 0 and table.read().count() == 100
