"""Alert suppression on a live stream: the state of a rule is when it may send again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions.columns import micros
from lakewarden.operators.alerts import cooldown


class CooldownStream:
    """Alerts that are sent. Each micro-batch is judged by the batch operator, so no task holds a rule.

    A small table with one row per rule goes from batch to batch; alerts before
    the moment it holds are dropped, the others are judged as if the rule had
    never sent. Within a batch alerts are judged in order of time; across
    batches they must arrive in that order (see ``ingest.arrivals``), as an
    alert older than the state is taken to be suppressed. A batch that runs
    again replaces what it has written.
    """

    def __init__(self, alerts: DataFrame, judge: Callable[[DataFrame, DataFrame | None], DataFrame], rules: Callable[[DataFrame], DataFrame]) -> None:
        self.alerts, self.judge, self.rules = alerts, judge, rules

    def drain(self, path: str, checkpoint: str) -> None:
        """Append what is sent now to Parquet, a folder per batch, and stop."""
        states = f"{checkpoint}-rules"
        state_schema = self.rules(self.alerts.limit(0)).schema
        # An input without rows still leaves a table.
        self.alerts.sparkSession.createDataFrame([], self.alerts.schema).write.mode("overwrite").parquet(f"{path}/batch=-1")

        def write(batch: DataFrame, batch_id: int) -> None:
            spark, before = batch.sparkSession, None
            if batch_id:
                before = spark.read.schema(state_schema).parquet(f"{states}/batch={batch_id - 1}")
            out = f"{path}/batch={batch_id}"
            self.judge(batch, before).write.mode("overwrite").parquet(out)
            now = self.rules(spark.read.schema(self.alerts.schema).parquet(out))
            if before is not None:
                now = now.unionByName(before).groupBy("__key").agg(F.max("__until").alias("__until"))
            now.write.mode("overwrite").parquet(f"{states}/batch={batch_id}")

        query = (
            self.alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
        query.awaitTermination()


def cooldown_stream(alerts: DataFrame, rule: str, ts: str, tie: str, cooldown_s: int) -> CooldownStream:
    """Alerts that are sent, as a stream to drain."""
    us = micros(F.col(ts))

    def judge(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        if before is not None:
            free = F.col("__until").isNull() | (us >= F.col("__until"))
            batch = batch.join(before, F.col(rule) == F.col("__key"), "left").where(free).drop("__key", "__until")
        return cooldown(batch, rule, ts, tie, cooldown_s)

    def rules(sent: DataFrame) -> DataFrame:
        return sent.groupBy(F.col(rule).alias("__key")).agg((F.max(us) + cooldown_s * 1_000_000).alias("__until"))

    return CooldownStream(alerts, judge, rules)
