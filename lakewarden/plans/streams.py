"""Streaming queries, drained to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators.rules import Field
from lakewarden.plans.monitoring import CHAIN
from lakewarden.plans.registry import query
from lakewarden.session import fresh_dir
from lakewarden.sources.versioned import VersionedTable
from lakewarden.streaming import alerts, ingest, rates

FIELDS = (Field("event_id", "long", False), Field("ts", "datetime", False), Field("user_id", "long", False),
          Field("event_type", "string", False), Field("value", "double"), Field("props", "string"))


@query("stream_ingest", sql="select event_id, ts, user_id, event_type, value from events")
def stream_ingest(t):
    root = fresh_dir(t.spark, "stream-ingest")
    table = VersionedTable.create(t.spark, f"{root}/table")
    stream = ingest.read_stream(t.spark, t.stream_path("events"), t.events)
    ingest.ingest(stream, table, FIELDS, f"{root}/checkpoint", report_path=f"{root}/reports", strict=True)
    return table.read().select("event_id", "ts", "user_id", "event_type", "value")


@query("stream_resume", sql="select event_id, event_type, ts from events")
def stream_resume(t):
    root = fresh_dir(t.spark, "stream-resume")
    source, events = f"{root}/source", t.events
    table = VersionedTable.create(t.spark, f"{root}/table")
    # Half arrives, is taken in, then the rest arrives and the stream resumes from its checkpoint.
    for half in (0, 1):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").parquet(source)
        ingest.ingest(ingest.read_stream(t.spark, source, events), table, FIELDS, f"{root}/checkpoint")
    # A batch that is run again is recognised by its number.
    table.commit(events, version=1)
    return table.read().select("event_id", "event_type", "ts")


@query("stream_cooldown", sql="with recursive " + CHAIN + """
select event_id, e.event_type, e.ts from events e join chain c on e.event_type = c.event_type and e.ts = c.ts""")
def stream_cooldown(t):
    root = fresh_dir(t.spark, "stream-cooldown")
    rows = t.events.select("event_id", "event_type", "ts")
    # Thirds in order of time, or smaller stretches of a large table, arrive one after the other.
    for stream in ingest.arrivals(rows, "ts", max(3, ingest.batches_of(t.events)), f"{root}/source"):
        sent = alerts.cooldown_stream(stream, "event_type", "ts", "event_id", 6 * 3600)
        rates.drain(sent, f"{root}/sent", f"{root}/checkpoint")
    return t.spark.read.schema(rows.schema).parquet(f"{root}/sent").select(*rows.columns)


@query("stream_error_rate", sql="""
with w as (select date_trunc('hour', ts) as start, event_type, count(*) as n from events group by 1, 2)
select start, start + interval 1 hour as "end", event_type, n from w""")
def stream_error_rate(t):
    root = fresh_dir(t.spark, "stream-rates")
    rows = t.events.select("ts", "event_type")
    for stream in ingest.arrivals(rows, "ts", ingest.batches_of(t.events), f"{root}/source"):
        rates.drain(rates.hourly_counts(stream, "ts", "event_type"), f"{root}/out", f"{root}/checkpoint")
    closed = t.spark.read.schema("start timestamp, end timestamp, event_type string, n bigint").parquet(f"{root}/out")
    out = closed.unionByName(rates.open_windows(t.spark, f"{root}/checkpoint", "event_type"))
    out = out.unionByName(rates.timeless(rows, "ts", "event_type"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"),
                      "event_type", "n")
