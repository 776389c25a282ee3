"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names, or "all"
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from lakewarden.plans import queries
from lakewarden.session import local_session

HEADLINE = (
    "scan_typed", "extract_incremental", "sink_roundtrip", "versioned_write", "time_travel",
    "schema_fingerprint", "schema_history", "sync_plan", "consistency_report", "error_rollup",
    "val_type", "val_record", "val_batch", "val_object", "val_gate", "profile_columns",
    "drift_report", "snapshot_files", "ckpt_structure", "backup_restorable", "backup_restore",
    "metric_anomalies", "metric_trend", "health_status", "alert_cooldown", "error_patterns",
    "op_metrics", "op_percentiles", "bottlenecks", "state_changes", "retry_health_score", "table_commits",
    "contract_report", "rule_scan", "finding_score", "event_alerts", "event_trend", "issue_dedup",
    "stream_ingest", "stream_error_rate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "")
    known = queries()
    names = list(known) if only == "all" else only.split(",") if only else list(HEADLINE)
    spark = local_session(cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executors' Python and the reader once, outside the measured time.
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    took = {}
    for name in names:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {took[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": float(scale[1]) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
