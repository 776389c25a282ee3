"""Row rules and verdicts: the cases a validator must get right."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import as_set
from lakewarden.operators import validation as v
from lakewarden.operators.rules import CustomRule, Field, compile_checks

RECORD = [
    Field("id", "string", False), Field("name", "string"), Field("age", "integer"),
    Field("email", "string"), Field("salary", "double"), Field("is_active", "boolean", False),
]
GOOD = {"id": '"1"', "name": '"Ann"', "age": "30", "email": '"ann@example.com"', "salary": "10.5", "is_active": "true"}


def variant_rows(spark, records, names):
    """Records of JSON values as dynamic columns, the way untyped sources deliver them."""
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ", ".join(f"{n} string" for n in names))
    return df.select(*[F.parse_json(n).alias(n) for n in names])


@pytest.mark.parametrize("change, errors, warnings", [
    ({}, 0, 0),
    ({"id": None}, 1, 0),
    ({"age": '"thirty"'}, 1, 0),
    ({"email": '"not-an-email"'}, 0, 0),
    ({"id": None, "age": '"x"', "is_active": '"yes"'}, 3, 0),
    ({"name": None, "age": None, "email": None, "salary": None}, 0, 0),
])
def test_record_cases_dynamic(spark, change, errors, warnings):
    df = variant_rows(spark, [{**GOOD, **change}], list(GOOD))
    row = v.record_verdict(df, RECORD, compile_checks(df, RECORD)).first()
    assert (len(row.errors), len(row.warnings)) == (errors, warnings)
    assert row.valid == (errors == 0)


def test_record_cases_text(rows):
    df = rows([("1", "Ann", "30", "ann@example.com", "1.5", "true"), ("2", "Bob", "thirty", "not-an-email", "x", "yes"),
               (None, None, None, None, None, None)],
              "id string, name string, age string, email string, salary string, is_active string")
    got = [(len(r.errors), len(r.warnings)) for r in v.record_verdict(df, RECORD, compile_checks(df, RECORD)).collect()]
    assert got == [(0, 0), (3, 1), (2, 0)]


def test_batch_of_five(spark):
    fields = [Field("id", "string", False), Field("value", "integer")]
    data = [('"1"', "100"), ('"2"', "200"), (None, "300"), ('"4"', '"text"'), ('"5"', "500")]
    df = variant_rows(spark, [{"id": a, "value": b} for a, b in data], ["id", "value"])
    row = v.batch_summary(df, [], fields, compile_checks(df, fields)).first()
    assert (row.total_records, row.valid_records, row.error_records, row.error_rate) == (5, 3, 2, 0.4)
    profiled = v.profile(df, ["id"], distinct=None).first()
    assert profiled.population_rate == 0.8


@pytest.mark.parametrize("declared, value, ok", [
    ("string", '"a"', True), ("string", "1", False), ("integer", "1", True), ("integer", "1.0", True),
    ("integer", "1.5", False), ("long", "2.0", True), ("long", '"2"', False), ("double", "1", True),
    ("double", "1.5", True), ("double", '"1.5"', False), ("boolean", "true", True), ("boolean", "1", False),
    ("date", '"2024-01-02"', True), ("datetime", '"2024-01-02T03:04:05Z"', True),
    ("datetime", '"2024-01-02T03:04:05.123+02:00"', True), ("datetime", '"2024-01-02T03:04:05"', True),
    ("datetime", '"2024-01-02 03:04:05"', True), ("datetime", '"02.01.2024"', False), ("binary", '"AA=="', True),
])
def test_type_table(spark, declared, value, ok):
    df = variant_rows(spark, [{"x": value}], ["x"])
    found = v.record_issues(df, [], compile_checks(df, [Field("x", declared)], ["type"])).count()
    assert (found == 0) == ok


@pytest.mark.parametrize("name, value, warns", [
    ("email", "a@b.co", 0), ("work_email", "a@b", 1), ("phone", "+14155550100", 0), ("phone", "0123", 1),
    ("website", "https://x.io", 0), ("home_url", "ftp://x.io", 1),
    ("order_id", "123e4567-e89b-12d3-a456-426614174000", 0), ("order_id", "z" * 36, 1), ("order_id", "short", 0),
    ("postal_code", "nonsense", 0),
])
def test_formats(rows, name, value, warns):
    df = rows([(value,)], f"{name} string")
    assert v.record_issues(df, [], compile_checks(df, [Field(name, "string")], ["format"])).count() == warns


def test_range_by_name_takes_any_substring(rows):
    df = rows([(151, 101.0, -1.0, -1.0)], "page_id int, tax_rate double, unit_cost double, other double")
    fields = [Field(c, "double") for c in df.columns]
    got = as_set(v.record_issues(df, [], compile_checks(df, fields, ["range"])).select("field"))
    assert got == {("page_id",), ("tax_rate",), ("unit_cost",)}


def test_quality(rows):
    df = rows([(" ",), ("N/A ",), ("x" * 101,), ("fine",)], "full_name string")
    got = [r[0] for r in v.record_issues(df, [], compile_checks(df, [Field("full_name", "string")], ["quality"])).select("value").collect()]
    assert sorted(got) == sorted([" ", "N/A ", "N/A ", "x" * 101])


@pytest.mark.parametrize("record, errors", [
    ({"id": '"1"', "age": "25", "status": '"active"'}, 0),
    ({"id": '"1"', "age": "-5", "status": '"active"'}, 1),
    ({"id": '"1"', "age": "150", "status": '"active"'}, 1),
    ({"id": '"1"', "age": "25", "status": '"gone"'}, 1),
    ({"id": '"1"', "age": "200", "status": '"gone"'}, 2),
    ({"id": '"1"', "age": "0", "status": None}, 0),
])
def test_custom_rules(spark, record, errors):
    fields = [Field("id", "string", False), Field("age", "integer"), Field("status", "string")]
    rules = [CustomRule("age", "range", min=0, max=120), CustomRule("status", "enum", values=("active", "inactive", "pending"))]
    df = variant_rows(spark, [record], ["id", "age", "status"])
    assert v.record_issues(df, [], compile_checks(df, fields, custom=rules)).count() == errors


def test_custom_check_from_pandas(rows):
    @F.pandas_udf("boolean")
    def odd(s: pd.Series) -> pd.Series:
        return s % 2 == 1

    df = rows([(1,), (2,), (None,)], "n int")
    rule = CustomRule("n", "custom", fails=odd("n"))
    assert v.record_issues(df, [], compile_checks(df, [Field("n", "integer")], [], [rule])).count() == 1


def test_sample_is_by_key_alone(spark):
    df = spark.range(10_000)
    kept = {r.id for r in v.hash_sample(df, ["id"], 0.3).collect()}
    assert 2800 < len(kept) < 3200 and max(kept) > 9900
    assert {r.id for r in v.hash_sample(df.where("id < 50"), ["id"], 0.3).collect()} == {i for i in kept if i < 50}
    assert v.hash_sample(df, ["id"], 1.0).count() == 10_000 and v.hash_sample(df, ["id"], 0.0).count() == 0


def test_report_over_two_batches(rows):
    batches = rows([("Account", 100, 80, 20, 0, 0.0), ("Account", 50, 50, 0, 0, 0.0)],
                   "o string, total_records long, valid_records long, error_records long, warning_records long, null_rate double")
    objects = v.object_rollup(batches, ["o"])
    row = objects.first()
    assert (row.total_records, row.status, round(row.error_rate, 6)) == (150, "error", round(20 / 150, 6))
    alerts = v.validation_alerts(objects, "o", 0.1).collect()
    assert [(a.type, a.severity) for a in alerts] == [("error_threshold", "low")]
    summary = v.run_summary(objects).first()
    assert (summary.error_objects, summary.overall_status) == (1, "error")


def test_strict_gate_holds_back_whole_objects(rows):
    df = rows([("a", 1), ("a", None), ("b", 2)], "o string, n int")
    checks = compile_checks(df, [Field("n", "integer", False)])
    assert as_set(v.strict_gate(df, ["o"], checks)) == {("b", 2)}
