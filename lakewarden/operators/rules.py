"""Validation rules compiled to Columns.

A rule turns a declared field into checks: a Column that is true where the
value breaks the rule, plus what to report. Nothing runs per row in Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Format patterns, matched by what the field name contains.
FORMATS = {
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "phone": r"^\+?[1-9]\d{1,14}$",
    "url": r"^https?://[^\s/$.?#].[^\s]*$",
    "uuid": r"^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$",
    "postal_code": r"^\d{5}(-\d{4})?$",
}
# Ranges by what the field name contains.
RANGES = {
    "percentage": (("percent", "percentage", "rate"), 0.0, 100.0),
    "age": (("age",), 0.0, 150.0),
    "revenue": (("revenue", "amount", "price", "cost"), 0.0, None),
}
# Text that stands for a missing value.
PLACEHOLDERS = ("n/a", "na", "null", "none", "unknown", "test", "example", "dummy")
WHITESPACE = " \t\n\v\f\r\u0085\u00a0"
# Accepted date layouts.
DATE_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
)


@dataclass(frozen=True)
class Field:
    """Declared field: one of the eight logical types."""

    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class CustomRule:
    """Rule given by the user for one field; ``fails`` may be any boolean Column."""

    field: str
    type: str
    min: float | None = None
    max: float | None = None
    values: Sequence[str] = ()
    pattern: str | None = None
    fails: Column | None = dc_field(default=None, compare=False)


@dataclass(frozen=True)
class Check:
    field: str
    kind: str
    severity: str
    fails: Column
    message: Column

    def issue(self) -> Column:
        """The report row of the check."""
        return F.struct(
            F.lit(self.field).alias("field"), F.lit(self.kind).alias("type"),
            self.message.alias("message"), F.col(self.field).cast("string").alias("value"),
            F.lit(self.severity).alias("severity"),
        )


def static_type(dtype: T.DataType) -> str:
    """Type name of every value of a typed column."""
    for kinds, name in (((T.StringType,), "string"), (INTEGRAL, "integer"), (FRACTIONAL, "float"),
                        ((T.BooleanType,), "boolean"), (MOMENTS, "datetime")):
        if isinstance(dtype, kinds):
            return name
    return "unknown"


def value_type(col: Column, dtype: T.DataType) -> Column:
    """Run-time type name of a value: string, integer, float, boolean, datetime or unknown."""
    if not isinstance(dtype, T.VariantType):
        return F.lit(static_type(dtype))
    name = F.schema_of_variant(col)
    return (
        F.when(name == "STRING", "string")
        .when(name.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "integer")
        .when(name.isin("FLOAT", "DOUBLE") | name.startswith("DECIMAL"), "float")
        .when(name == "BOOLEAN", "boolean")
        .when(name.isin("DATE", "TIMESTAMP", "TIMESTAMP_NTZ"), "datetime")
        .otherwise("unknown")
    )


def date_text(col: Column) -> Column:
    """Text that reads as one of the accepted date layouts."""
    out = F.lit(False)
    for layout in DATE_LAYOUTS:
        out = out | F.try_to_timestamp(col, F.lit(layout)).isNotNull()
    return out


def _integral_text(text: Column) -> Column:
    number = text.try_cast("double")
    return text.try_cast("long").isNotNull() | F.coalesce(number == F.floor(number), F.lit(False))


def _text_fits(text: Column, declared: str) -> Column | bool:
    """Untyped text is judged by what it can be read as."""
    if declared in ("string", "binary"):
        return True
    if declared in ("integer", "long"):
        return _integral_text(text)
    if declared == "double":
        return text.try_cast("double").isNotNull()
    if declared == "boolean":
        return F.lower(text).isin("true", "false")
    if declared in ("date", "datetime"):
        return date_text(text)
    return False


def _whole(number: Column) -> Column:
    return F.coalesce(number == F.floor(number), F.lit(False))


# Value types that a declared type takes as they are.
TAKES = {
    "string": ("string",), "binary": ("string",), "integer": ("integer",), "long": ("integer",),
    "double": ("float", "integer"), "boolean": ("boolean",), "date": ("datetime",), "datetime": ("datetime",),
}


def _typed_fits(col: Column, dtype: T.DataType, declared: str) -> Column | bool:
    """A typed column is settled when the plan is built, but for fractions that may be whole."""
    actual = static_type(dtype)
    if actual in TAKES.get(declared, ()):
        return True
    return _whole(col) if declared in ("integer", "long") and actual == "float" else False


def _variant_fits(col: Column, dtype: T.DataType, declared: str) -> Column | bool:
    """Dynamic values are judged by the type each one carries."""
    actual = value_type(col, dtype)
    fits = actual.isin(*TAKES.get(declared, ("",)))
    if declared in ("integer", "long"):
        return fits | ((actual == "float") & _whole(F.try_variant_get(col, "$", "double")))
    if declared in ("date", "datetime"):
        return fits | ((actual == "string") & date_text(F.try_variant_get(col, "$", "string")))
    return fits


def type_checks(f: Field, dtype: T.DataType) -> list[Check]:
    col = F.col(f.name)
    if isinstance(dtype, T.StringType):
        fits = _text_fits(col, f.type)
    elif isinstance(dtype, T.VariantType):
        fits = _variant_fits(col, dtype, f.type)
    else:
        fits = _typed_fits(col, dtype, f.type)
    if fits is True:
        return []
    fails = col.isNotNull() if fits is False else col.isNotNull() & ~fits
    message = F.concat(F.lit(f"Expected {f.type} but got "), value_type(col, dtype))
    return [Check(f.name, "type_mismatch", "error", fails, message)]


def null_checks(f: Field, dtype: T.DataType) -> list[Check]:
    if f.nullable:
        return []
    return [Check(f.name, "null_constraint", "error", F.col(f.name).isNull(),
                  F.lit(f"Field {f.name} cannot be null"))]


def format_checks(f: Field, dtype: T.DataType) -> list[Check]:
    """Which pattern applies follows from the field name, so it is settled when the plan is built."""
    if not isinstance(dtype, T.StringType):
        return []
    col, name = F.col(f.name), f.name.lower()
    if "email" in name:
        kind, what, applies = "email", "an email", F.lit(True)
    elif "phone" in name:
        kind, what, applies = "phone", "a phone number", F.lit(True)
    elif "url" in name or "website" in name:
        kind, what, applies = "url", "a URL", F.lit(True)
    elif "id" in name:
        kind, what, applies = "uuid", "a UUID", F.octet_length(col) == 36
    else:
        return []
    return [Check(f.name, "format_invalid", "warning",
                  col.isNotNull() & applies & ~col.rlike(FORMATS[kind]),
                  F.lit(f"Field {f.name} appears to be {what} but has another format"))]


def range_checks(f: Field, dtype: T.DataType, ranges: dict | None = None) -> list[Check]:
    if not isinstance(dtype, INTEGRAL + FRACTIONAL):
        return []
    col, name, out = F.col(f.name), f.name.lower(), []
    for label, (parts, low, high) in {**(ranges or {}), **RANGES}.items():
        if not any(part in name for part in parts):
            continue
        if low is not None:
            out.append(Check(f.name, "range_violation", "warning", F.coalesce(col < low, F.lit(False)),
                             F.concat(F.lit("Value "), col.cast("string"),
                                      F.lit(f" is below expected minimum {low:g} for {label}"))))
        if high is not None:
            out.append(Check(f.name, "range_violation", "warning", F.coalesce(col > high, F.lit(False)),
                             F.concat(F.lit("Value "), col.cast("string"),
                                      F.lit(f" is above expected maximum {high:g} for {label}"))))
    return out


def quality_checks(f: Field, dtype: T.DataType) -> list[Check]:
    if not isinstance(dtype, T.StringType):
        return []
    col = F.col(f.name)
    bare = F.btrim(col, F.lit(WHITESPACE))
    present = col.isNotNull()

    def warn(fails: Column, message: Column) -> Check:
        return Check(f.name, "data_quality", "warning", present & fails, message)

    out = [
        warn(bare == "", F.lit(f"Field {f.name} contains empty string, consider null value")),
        warn(F.lower(bare).isin(*PLACEHOLDERS),
             F.concat(F.lit(f"Field {f.name} contains suspicious placeholder value: "), col)),
        warn((F.length(col) != F.length(bare)) & (F.length(bare) > 0),
             F.lit(f"Field {f.name} contains leading/trailing whitespace")),
    ]
    if "name" in f.name.lower():
        out.append(warn(F.octet_length(col) > 100,
                        F.concat(F.lit(f"Field {f.name} has unusually long value ("),
                                 F.octet_length(col).cast("string"), F.lit(" characters) for a name field"))))
    return out


def custom_checks(rule: CustomRule, dtype: T.DataType) -> list[Check]:
    """User rules; all but ``required`` pass over NULL."""
    col = F.col(rule.field)

    def fail(cond: Column, message: Column) -> Check:
        return Check(rule.field, "custom_rule", "error",
                     col.isNotNull() & F.coalesce(cond, F.lit(False)), message)

    if rule.fails is not None:
        return [fail(rule.fails, F.lit(f"custom check failed for {rule.field}"))]
    if rule.type == "range":
        if isinstance(dtype, T.VariantType):
            numeric = value_type(col, dtype).isin("integer", "float")
            number = F.when(numeric, F.try_variant_get(col, "$", "double"))
        elif isinstance(dtype, INTEGRAL + FRACTIONAL):
            numeric, number = F.lit(True), col.cast("double")
        else:
            numeric, number = F.lit(False), F.lit(None).cast("double")
        out = [fail(~numeric, F.lit("expected numeric value for range validation"))]
        if rule.min is not None:
            out.append(fail(number < rule.min,
                            F.concat(F.lit("value "), number.cast("string"), F.lit(f" is below minimum {rule.min:g}"))))
        if rule.max is not None:
            out.append(fail(number > rule.max,
                            F.concat(F.lit("value "), number.cast("string"), F.lit(f" is above maximum {rule.max:g}"))))
        return out
    if rule.type == "enum":
        if isinstance(dtype, T.VariantType):
            text = F.when(value_type(col, dtype) == "string", F.try_variant_get(col, "$", "string"))
        elif isinstance(dtype, T.StringType):
            text = col
        else:
            text = F.lit(None).cast("string")
        return [
            fail(text.isNull(), F.lit("expected string value for enum validation")),
            fail(~text.isin(*rule.values), F.concat(F.lit("value "), text, F.lit(" is not in allowed values"))),
        ]
    if rule.type == "regex":
        return [fail(~col.cast("string").rlike(rule.pattern), F.lit(f"value does not match {rule.pattern}"))]
    if rule.type == "required":
        return [Check(rule.field, "custom_rule", "error", col.isNull(), F.lit(f"Field {rule.field} is required"))]
    raise ValueError(f"unknown rule type {rule.type}")


RULES = {"type": type_checks, "null": null_checks, "format": format_checks,
         "range": range_checks, "quality": quality_checks}
DEFAULT_RULES = ("type", "null", "format")


def compile_checks(
    df: DataFrame,
    fields: Iterable[Field],
    rules: Sequence[str] = DEFAULT_RULES,
    custom: Sequence[CustomRule] = (),
) -> list[Check]:
    """All checks of the declared fields against the columns the DataFrame has."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[Check] = []
    for f in fields:
        for rule in rules:
            out += RULES[rule](f, types[f.name])
        for rule in custom:
            if rule.field == f.name:
                out += custom_checks(rule, types[f.name])
    return out
