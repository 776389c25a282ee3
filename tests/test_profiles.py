"""Mergeable profiles: merged parts against the whole, and both against plain counts."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import profiles

COLUMNS = ["number", "text", "empty", "value"]


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(12)
    rows = [(draw.randrange(30), draw.gauss(50, 20) if draw.random() < 0.9 else None, draw.choice(["a", "bb", "ccc"]) if draw.random() < 0.8 else f"t{i}", None,
             draw.choice(["1", "2.5", '"x"', "true", None])) for i in range(20_000)]
    df = spark.createDataFrame(rows, "batch int, number double, text string, empty string, value string")
    return rows, df.withColumn("value", F.parse_json("value"))


def by_field(df):
    return {r.field: r for r in df.collect()}


def test_merged_parts_equal_the_whole(spark, table):
    rows, df = table
    whole = by_field(profiles.finish(profiles.accumulate(df, COLUMNS)))
    parts = profiles.accumulate(df, COLUMNS, ["batch"])
    days = profiles.merge(parts.withColumn("day", F.col("batch") % 4), ["day"])
    merged = by_field(profiles.finish(profiles.merge(days)))
    numbers = sorted(r[1] for r in rows if r[1] is not None)
    for got in (whole, merged):
        one = got["number"]
        assert (one.non_null_count, one.null_count, one.min, one.max) == (len(numbers), 20_000 - len(numbers), numbers[0], numbers[-1])
        assert abs(one.mean - statistics.fmean(numbers)) < 1e-9 and abs(one.stddev - statistics.pstdev(numbers)) < 1e-6
        for share, value in zip((0.5, 0.95, 0.99), one.quantiles):
            rank = sum(n <= value for n in numbers) / len(numbers)
            assert abs(rank - share) < 0.02
        assert abs(got["text"].unique_values - len({r[2] for r in rows})) < 0.05 * len({r[2] for r in rows})
        assert got["text"].average_length == pytest.approx(statistics.fmean(len(r[2]) for r in rows))
        assert got["empty"].stddev is None and got["text"].stddev is None and got["empty"].mean is None
        assert got["empty"].non_null_count == 0 and got["empty"].quantiles is None and got["empty"].value_types == []
        kinds = {x.value_type: x.n for x in got["value"].value_types}
        want = {"integer": "1", "float": "2.5", "string": '"x"', "boolean": "true"}
        assert kinds == {k: sum(r[4] == v for r in rows) for k, v in want.items()}
        assert {x.item for x in got["text"].frequent_values[:3]} == {"a", "bb", "ccc"}


def test_frequencies_are_exact_while_few_values_are_seen(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("v"), (F.col("id") % 7).alias("b"))
    got = by_field(profiles.finish(profiles.merge(profiles.accumulate(df, ["v"], ["b"]))))["v"]
    assert sorted((x.item, x["count"]) for x in got.frequent_values) == [("0", 1000), ("1", 1000), ("2", 1000)]


def test_tables_without_rows(spark):
    none = spark.createDataFrame([], "v double")
    assert by_field(profiles.finish(profiles.accumulate(none, ["v"])))["v"].non_null_count == 0
    assert profiles.merge(profiles.accumulate(none, ["v"])).count() == 0
    some = profiles.accumulate(spark.createDataFrame([(1.0,), (3.0,)], "v double"), ["v"])
    both = by_field(profiles.finish(profiles.merge(some.unionByName(profiles.accumulate(none, ["v"])))))["v"]
    assert (both.non_null_count, both.mean, both.stddev) == (2, 2.0, 1.0)
