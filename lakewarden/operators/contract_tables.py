"""Contracts and recording filters that are tables themselves, of any number of rows.

"The URL ends with the path" is a theta join. It becomes an equi join: each
different call gives out the endings of its URL that have the length of some
path, and the longest that meets a path of its method wins. Only the different
lengths reach the driver, never more than the longest path has characters.
Paths that begin with a slash meet endings that do, a handful per URL.

Endpoints have the columns method and path, and timeout_ms, statuses (a list)
and headers (a map; an empty value takes any) where known; without statuses
every status is unexpected. Rows without method or path take no part. If an
endpoint stands several times, the greatest row by timeout, statuses and headers counts. Calls
without URL or method match nothing. Bodies are checked by compiled contracts
(``contracts``), as their schemas shape the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.columns import severity_rank
from lakewarden.operators.contracts import TIMEOUT_TOLERANCE_MS, VIOLATION
from lakewarden.session import settled

ENDPOINT = "__method", "__path"
CALL = "__method", "__tail"


def _known(endpoints: DataFrame) -> DataFrame:
    """One row per method and path, written once: the join sees its size."""

    def given(name: str, kind: str) -> Column:
        return (F.col(name) if name in endpoints.columns else F.lit(None)).cast(kind)

    contract = F.struct(
        given("timeout_ms", "long").alias("timeout_ms"), F.array_sort(given("statuses", "array<int>")).alias("statuses"),
        F.array_sort(F.map_entries(given("headers", "map<string,string>"))).alias("headers"))
    named = endpoints.where(F.col("method").isNotNull() & F.col("path").isNotNull())
    return settled(named.groupBy(F.upper("method").alias("__method"), F.col("path").alias("__path")).agg(
        F.max(contract).alias("__contract")), "endpoints")


def _lengths(df: DataFrame, name: str) -> tuple[list[int], list[int]]:
    """The different lengths of texts that begin with a slash, and of all others."""
    slashed, size = F.startswith(name, F.lit("/")), F.length(name)
    found = df.agg(F.collect_set(F.when(slashed, size)).alias("a"), F.collect_set(F.when(~slashed, size)).alias("b")).first()
    return sorted(found.a), sorted(found.b)


def _ints(values: Sequence[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<int>")


def _endings(text: Column, slashed: Sequence[int], others: Sequence[int]) -> Column:
    """Endings of a text of the given lengths, the first kind only where they begin with a slash."""

    def cut(n: Column) -> Column:
        return F.right(text, n)

    return F.array_distinct(F.concat(
        F.filter(F.transform(_ints(slashed), cut), lambda x: x.startswith("/")), F.transform(_ints(others), cut)))


def matched(recordings: DataFrame, endpoints: DataFrame, contract: bool = False) -> DataFrame:
    """Recordings with ``endpoint``, the name of the one they match, and its contract if asked for.

    Work is per different call: repeated URLs, however many, are looked up once.
    """
    known = _known(endpoints)
    slashed, others = _lengths(known, "__path")
    calls = recordings.withColumns({
        "__method": F.upper("method"), "__tail": F.right("url", F.lit(max(slashed + others, default=0)))})
    endings = calls.select(*CALL).distinct().select(*CALL, F.explode(_endings(F.col("__tail"), slashed, others)).alias("__path"))
    best = endings.join(known, list(ENDPOINT)).groupBy(*CALL).agg(
        F.max_by(F.struct("__path", "__contract"), F.length("__path")).alias("__best"))
    kept = [c for c in recordings.columns if c != "endpoint"]
    out = calls.join(best, list(CALL), "left").select(
        *kept, F.concat("__method", F.lit(" "), "__best.__path").alias("endpoint"), F.col("__best.__contract").alias("__contract"))
    return out if contract else out.drop("__contract")


def _item(kind: str, field: Column, severity: str, description: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), field.alias("field"), F.lit(severity).alias("severity"), description.alias("description"))


def conformance(recordings: DataFrame, endpoints: DataFrame, tolerance_ms: int = TIMEOUT_TOLERANCE_MS) -> DataFrame:
    """Each recording with its endpoint, violations of status, headers and timeout, and success."""
    nothing = F.lit("")
    contract = F.col("__contract")
    statuses = contract["statuses"]
    found = F.col("endpoint").isNotNull()
    single = (
        (~found, "connectivity", "critical", "no matching endpoint found in contract"),
        (found & (F.coalesce(F.size(statuses), F.lit(0)) <= 0) | found & ~F.array_contains(statuses, F.col("status")),
         "status_code", "high", "unexpected status code"),
        ((contract["timeout_ms"] > 0) & (F.col("duration_ms") > contract["timeout_ms"] + tolerance_ms),
         "timeout", "medium", "response time exceeded timeout threshold"),
    )
    items = F.array_compact(F.array(*[F.when(cond, _item(kind, nothing, severity, F.lit(text))) for cond, kind, severity, text in single]))
    parts = [items.cast(VIOLATION)]
    if "headers" in recordings.columns:
        def got(h: Column) -> Column:
            return F.try_element_at(F.col("headers"), h["key"])

        def fault(h: Column) -> Column:
            return F.concat(F.lit("header "), h["key"], F.lit(" value mismatch"))

        wrong = F.filter(contract["headers"], lambda h: got(h).isNull() | ((h["value"] != "") & (got(h) != h["value"])))
        told = F.transform(wrong, lambda h: _item("headers", h["key"], "medium", F.when(
            got(h).isNull(), F.concat(F.lit("expected header "), h["key"], F.lit(" is missing"))).otherwise(fault(h))))
        parts.append(F.coalesce(told.cast(VIOLATION), F.array().cast(VIOLATION)))
    worst = F.array_max(F.transform("violations", lambda x: severity_rank(x["severity"])))
    return (
        matched(recordings, endpoints, contract=True).withColumn("violations", F.concat(*parts)).drop("__contract")
        .withColumn("success", F.coalesce(worst < 3, F.lit(True))))


def keep_recordings(recordings: DataFrame, filters: DataFrame) -> DataFrame:
    """Recordings that pass any filter (base, ending): the start of the URL's base and the end of its path.

    Null or empty takes any; without filters all stay. Each different URL is
    looked up once, by equality with pairs of its beginnings and endings.
    """
    named = settled(filters.select(F.coalesce("base", F.lit("")).alias("__base"), F.coalesce("ending", F.lit("")).alias("__ending")).distinct(), "filters")
    slashed, others = _lengths(named, "__ending")
    some = named.agg(F.collect_set(F.length("__base")).alias("sizes"), F.count_if(
        (F.col("__base") == "") & (F.col("__ending") == "")).alias("open")).first()
    if some.open or not some.sizes:
        return recordings

    def part(name: str) -> Column:
        return F.try_parse_url(F.col("url"), F.lit(name))

    beginnings = F.array_distinct(F.transform(_ints(sorted(some.sizes)), lambda n: F.left(F.col("__b"), n)))
    urls = recordings.select("url").distinct().select(
        "url", F.coalesce(F.concat(part("PROTOCOL"), F.lit("://"), part("AUTHORITY")), F.lit("")).alias("__b"),
        F.coalesce(part("PATH"), F.lit("")).alias("__p"))
    pairs = urls.select("url", "__p", F.explode(beginnings).alias("__base")).select(
        "url", "__base", F.explode(_endings(F.col("__p"), slashed, others)).alias("__ending"))
    kept = pairs.join(named, ["__base", "__ending"], "left_semi").select("url").distinct()
    return recordings.join(kept, "url", "left_semi").select(*recordings.columns)
