"""Conformance of recorded API calls to a contract.

A contract is a short list of endpoints known when the plan is built, so
matching and every check become Columns: no join, no shuffle, one pass over
the recordings. A recording is (request_id, method, url, status, headers map,
body as JSON text, duration_ms).
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.columns import severity_rank

# Tolerance over an endpoint's timeout, headers never kept.
TIMEOUT_TOLERANCE_MS = 5_000
SENSITIVE_HEADERS = ("authorization", "cookie", "x-api-key", "x-auth-token")
VIOLATION = "array<struct<type:string,field:string,severity:string,description:string>>"


@dataclass(frozen=True)
class Endpoint:
    method: str
    path: str
    responses: Mapping[int, Mapping | None] = field(default_factory=dict)
    headers: Mapping[str, str] = field(default_factory=dict)
    timeout_ms: int = 0

    @property
    def name(self) -> str:
        return f"{self.method.upper()} {self.path}"


@dataclass(frozen=True)
class Leaf:
    """One possible violation: when it holds and what to report."""

    holds: Column
    type: str
    field: Column | str
    severity: str
    description: Column | str

    def item(self) -> Column:
        return F.struct(*[
            (F.lit(x) if isinstance(x, str) else x).alias(n)
            for n, x in (("type", self.type), ("field", self.field), ("severity", self.severity), ("description", self.description))])


@dataclass(frozen=True)
class Found:
    """Possible violations of a row: single ones, and arrays of any number (items, unknown keys).

    ``values`` are the parts of a body that checks look at; each is taken out,
    and its type named, once per row however many checks and endpoints use it.
    """

    leaves: list[Leaf]
    arrays: list[Column] = field(default_factory=list)
    values: dict[str, Column] = field(default_factory=dict)

    def __add__(self, other: Found) -> Found:
        return Found(self.leaves + other.leaves, self.arrays + other.arrays, {**self.values, **other.values})

    def prepare(self, rows: DataFrame) -> DataFrame:
        if not self.values:
            return rows
        return rows.withColumns(self.values).withColumns(
            {type_of(name): F.schema_of_variant(F.col(name)) for name in self.values})

    def as_array(self) -> Column:
        """All violations as one array."""
        none = F.array().cast(VIOLATION)
        parts = [F.when(x.holds, F.array(x.item())).otherwise(none) for x in self.leaves]
        return F.concat(none, *parts, *[F.coalesce(x, none) for x in self.arrays])


def type_of(value: str) -> str:
    return f"{value}_type"


def match_endpoint(endpoints: Sequence[Endpoint]) -> Column:
    """Name of the endpoint with the same method whose path ends the URL; the longest path wins."""
    lengths = sorted({len(e.path) for e in endpoints}, reverse=True)
    tries = []
    for n in lengths:
        same = [e for e in endpoints if len(e.path) == n]
        key = F.concat(F.upper("method"), F.lit(" "), F.right(F.col("url"), F.lit(n)))
        tries.append(F.when(key.isin(*[e.name for e in same]), key))
    return F.coalesce(*tries, F.lit(None).cast("string"))


def _is(e: Endpoint) -> Column:
    return F.col("endpoint") == e.name


def status_check(endpoints: Sequence[Endpoint]) -> Found:
    return Found([
        Leaf(_is(e) & ~F.col("status").isin(*e.responses) if e.responses else _is(e),
             "status_code", "", "high", "unexpected status code")
        for e in endpoints])


def header_check(endpoints: Sequence[Endpoint]) -> Found:
    out = []
    for e in endpoints:
        for name, want in e.headers.items():
            got = F.try_element_at(F.col("headers"), F.lit(name))
            out.append(Leaf(_is(e) & got.isNull(), "headers", name, "medium", f"expected header {name} is missing"))
            if want:
                out.append(Leaf(_is(e) & (got != want), "headers", name, "medium", f"header {name} value mismatch"))
    return Found(out)


def timeout_check(endpoints: Sequence[Endpoint], tolerance_ms: int = TIMEOUT_TOLERANCE_MS) -> Found:
    return Found([
        Leaf(_is(e) & (F.col("duration_ms") > e.timeout_ms + tolerance_ms),
             "timeout", "", "medium", "response time exceeded timeout threshold")
        for e in endpoints if e.timeout_ms > 0])


def json_is(v: Column, want: str, name: Column | None = None) -> Column:
    """Whether a variant is of a JSON type; integer takes any number without a fraction."""
    name = F.schema_of_variant(v) if name is None else name
    if want == "object":
        return name.startswith("OBJECT")
    if want == "array":
        return name.startswith("ARRAY")
    if want in ("number", "integer"):
        number = name.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | name.startswith("DECIMAL")
        value = F.try_variant_get(v, "$", "double")
        return number & (value == F.floor(value)) if want == "integer" else number
    return name == {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}.get(want, "?")


# First character of JSON text by type.
FIRST = {"object": "{", "array": "[", "string": '"', "boolean": "tf", "null": "n", "number": "-0123456789", "integer": "-0123456789"}


def text_is(text: Column, v: Column, want: str) -> Column:
    """Type of a whole JSON text by its first character: the schema of a large variant is never spelled out."""
    first = F.substring(F.btrim(text, F.lit(" \t\n\r")), 1, 1)
    fits = v.isNotNull() & first.isin(*FIRST.get(want, "?"))
    if want != "integer":
        return fits
    value = F.try_variant_get(v, "$", "double")
    return fits & (value == F.floor(value))


def _equals(v: Column, value, name: Column | None) -> Column:
    kind, as_type = (
        ("null", None) if value is None else ("boolean", "boolean") if isinstance(value, bool)
        else ("number", "double") if isinstance(value, (int, float)) else ("string", "string"))
    fits = json_is(v, kind, name)
    return fits & (F.try_variant_get(v, "$", as_type) == F.lit(value)) if as_type else fits


def _joined(path: Column | str, name: Column | str) -> Column | str:
    if isinstance(path, str) and isinstance(name, str):
        return f"{path}.{name}" if path else name
    path, name = (F.lit(x) if isinstance(x, str) else x for x in (path, name))
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def schema_check(
    schema: Mapping, root: Column, guard: Column, at: str = "$", path: Column | str = "", strict: bool = False,
    text: Column | None = None,
) -> Found:
    """Possible violations of a nested JSON schema, walked once while the plan is built.

    ``root`` is the variant, ``at`` the JSON path inside it, ``guard`` when
    this part of the schema applies: all parents have their type and the
    property is there. A wrong type ends the walk on this branch. ``text`` is
    what the root was parsed from, if it is at hand.
    """
    want, out, arrays, values = schema.get("type"), [], [], {}
    if at == "$":
        v, name = root, None
    elif text is None:
        v, name = F.try_variant_get(root, at, "variant"), None
    else:
        key = "__at_" + hashlib.md5(at.encode()).hexdigest()[:12]
        values[key] = F.try_variant_get(root, at, "variant")
        v, name = F.col(key), F.col(type_of(key))
    inside = guard
    if want:
        fits = text_is(text, v, want) if text is not None and at == "$" else json_is(v, want, name)
        out.append(Leaf(guard & F.coalesce(~fits, F.lit(True)), "schema", path, "medium", "type mismatch"))
        inside = guard & fits

    def bad(cond: Column, text: str, severity: str = "medium", where: Column | str = path) -> None:
        out.append(Leaf(inside & cond, "schema", where, severity, text))

    if schema.get("enum"):
        hit = F.lit(False)
        for value in schema["enum"]:
            hit = hit | F.coalesce(_equals(v, value, name), F.lit(False))
        bad(~hit, "value not in enum")
    if want == "string":
        value = F.try_variant_get(v, "$", "string")
        if schema.get("pattern"):
            bad(~value.rlike(schema["pattern"]), "string does not match pattern")
        if "minLength" in schema:
            bad(F.octet_length(value) < schema["minLength"], "string too short")
        if "maxLength" in schema:
            bad(F.octet_length(value) > schema["maxLength"], "string too long")
    elif want in ("number", "integer"):
        number = F.try_variant_get(v, "$", "double")
        if "minimum" in schema:
            bad(number < float(schema["minimum"]), "number below minimum")
        if "maximum" in schema:
            bad(number > float(schema["maximum"]), "number above maximum")
    elif want == "object":
        properties = schema.get("properties", {})

        def there(prop: str) -> Column:
            return F.try_variant_get(root, f"{at}['{prop}']", "variant").isNotNull()

        for prop in schema.get("required", ()):
            bad(~there(prop), "required property is missing", "high", _joined(path, prop))
        for prop, inner in properties.items():
            found = schema_check(inner, root, inside & there(prop), f"{at}['{prop}']", _joined(path, prop), strict, text)
            out, arrays, values = out + found.leaves, arrays + found.arrays, {**values, **found.values}
        if strict:
            keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
            extra = F.array_except(keys, F.array(*[F.lit(n) for n in properties]).cast("array<string>"))
            arrays.append(F.when(inside, F.transform(extra, lambda k: Leaf(
                F.lit(True), "schema", _joined(path, k), "low", "unexpected property").item())))
    elif want == "array" and schema.get("items"):
        items = F.try_variant_get(v, "$", "array<variant>")
        base = F.lit(path) if isinstance(path, str) else path
        arrays.append(F.when(inside, F.flatten(F.transform(items, lambda x, i: schema_check(
            schema["items"], x, F.lit(True), "$", F.concat(base, F.lit("["), i.cast("string"), F.lit("]")), strict
        ).as_array()))))
    return Found(out, arrays, values)


def body_check(endpoints: Sequence[Endpoint], strict: bool = False) -> Found:
    """Violations of the response schema for the status; ``json`` is the parsed body of ``matched``."""
    out = Found([])
    for e in endpoints:
        for status, schema in e.responses.items():
            if schema:
                out = out + schema_check(schema, F.col("json"), _is(e) & (F.col("status") == status), strict=strict,
                                         text=F.col("body"))
    return out


def matched(recordings: DataFrame, endpoints: Sequence[Endpoint]) -> DataFrame:
    """Recordings with the endpoint they match and the body parsed once."""
    out = recordings.withColumn("endpoint", match_endpoint(endpoints))
    return out.withColumn("json", F.try_parse_json("body")) if "body" in recordings.columns else out


def conformance(
    recordings: DataFrame, endpoints: Sequence[Endpoint], strict: bool = False,
    tolerance_ms: int = TIMEOUT_TOLERANCE_MS,
) -> DataFrame:
    """Each recording with its endpoint, violations, sizes and success; narrow all the way."""
    found = status_check(endpoints) + body_check(endpoints, strict) + timeout_check(endpoints, tolerance_ms)
    if "headers" in recordings.columns:
        found = found + header_check(endpoints)
    lost = Found([Leaf(F.col("endpoint").isNull(), "connectivity", "", "critical", "no matching endpoint found in contract")])
    worst = F.array_max(F.transform("violations", lambda x: severity_rank(x["severity"])))
    return (
        found.prepare(matched(recordings, endpoints)).withColumn("violations", (lost + found).as_array())
        .select(*recordings.columns, "endpoint", "violations")
        .withColumn("success", F.coalesce(worst < 3, F.lit(True)))
        .withColumn("response_size", F.octet_length("body")))


def violations_of(rows: DataFrame, keys: Sequence[str], found: Found) -> DataFrame:
    """One row per violation.

    The array is made by a projection, which shares common parts; the outer
    form of inline keeps the optimizer from making it a second time in a filter.
    """
    made = found.prepare(rows).select(*keys, found.as_array().alias("__found"))
    return made.select(*keys, F.inline_outer("__found")).where(F.col("type").isNotNull())


def keep_recordings(recordings: DataFrame, filters: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Recordings that pass any filter of (base URL prefix, path endings); all when there is none."""
    if not filters:
        return recordings
    base = F.concat(F.parse_url(F.col("url"), F.lit("PROTOCOL")), F.lit("://"), F.parse_url(F.col("url"), F.lit("AUTHORITY")))
    path = F.parse_url(F.col("url"), F.lit("PATH"))
    keep = F.lit(False)
    for prefix, endings in filters:
        cond = base.startswith(prefix) if prefix else F.lit(True)
        if endings:
            ends = F.lit(False)
            for e in endings:
                ends = ends | path.endswith(e)
            cond = cond & ends
        keep = keep | cond
    return recordings.where(keep)


def redact_headers(df: DataFrame, headers: str = "headers") -> DataFrame:
    return df.withColumn(headers, F.map_filter(headers, lambda k, v: ~F.lower(k).isin(*SENSITIVE_HEADERS)))
