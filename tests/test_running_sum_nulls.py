"""Running totals keep the rows of a null key and those without time."""

from pyspark.sql import functions as F

from lakewarden.functions.windows import running_sum


def test_null_key_and_null_time_stay(spark):
    data = [(None, 0, 1), (None, 90_000, 2), ("a", None, 4), ("a", 10, 8), ("a", 200_000, 16)]
    df = spark.createDataFrame(data, "metric string, t long, v long").withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.metric, r.t, r.v) for r in running_sum(df, ["metric"], "ts", ["v"]).collect()}
    assert got == {(None, 0, 1), (None, 90_000, 3), ("a", None, 4), ("a", 10, 12), ("a", 200_000, 28)}
