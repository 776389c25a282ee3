"""Regex rule scans over text, finding filters and scores, advisories."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.functions.columns import clamp, ladder_at_least
from lakewarden.functions.literals import candidates, required_literals

# Penalties by severity and CVSS cut-offs.
FINDING_PENALTY = {"low": 0.5, "medium": 2.0, "high": 5.0, "critical": 10.0}
ADVISORY_PENALTY = {"low": 1.0, "medium": 3.0, "high": 8.0, "critical": 15.0}
CVSS = [(9.0, "critical"), (7.0, "high"), (4.0, "medium")]
CVSS_EXTRA = ((9.0, 5.0), (7.0, 2.0))


@dataclass(frozen=True)
class ScanRule:
    id: str
    pattern: str
    severity: str
    name: str = ""
    # Text that every match contains, where the pattern does not show it.
    literal: str | None = None


def usable_rules(spark: SparkSession, rules: Sequence[ScanRule]) -> list[ScanRule]:
    """Rules whose pattern the regex engine accepts; a bad pattern is left out."""
    out = []
    for rule in rules:
        try:
            spark._jvm.java.util.regex.Pattern.compile(rule.pattern)
        except Exception:  # noqa: BLE001 - the engine's own error for a bad pattern
            continue
        out.append(rule)
    return out


def _sum(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc + x)


def _starts(line: Column, pattern: Column) -> Column:
    """1-based column of every match: the text between matches and the matches add up to it.

    Lengths are summed in blocks of about the square root of their number, so a
    line with very many matches is not summed anew for each.
    """
    found = F.regexp_extract_all(line, pattern, F.lit(0))
    pairs = F.arrays_zip(found.alias("match"), F.split(line, pattern, -1).alias("before"))

    def placed(pairs: Column, steps: Column, size: Column, offsets: Column) -> Column:
        return F.transform(pairs, lambda x, i: F.struct(
            (F.get(offsets, F.floor(i / size).cast("int")) + _sum(F.slice(steps, (F.floor(i / size) * size + 1).cast("int"), i % size))
             + F.length(x["before"]) + 1).cast("int").alias("column"), x["match"].alias("match")))

    def with_offsets(pairs: Column, steps: Column, size: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(steps) / size).cast("int"))
        sums = F.transform(blocks, lambda b: _sum(F.slice(steps, b * size + 1, size)))
        offsets = F.transform(blocks, lambda b: named(sums, lambda s: _sum(F.slice(s, F.lit(1), b))))
        return named(offsets, lambda o: placed(pairs, steps, size, o))

    def with_steps(pairs: Column) -> Column:
        steps = F.transform(pairs, lambda x: F.length(x["before"]) + F.coalesce(F.length(x["match"]), F.lit(0)))
        size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(pairs))).cast("int"))
        return named(steps, lambda st: with_offsets(pairs, st, size))

    return F.filter(named(pairs, with_steps), lambda x: x["match"].isNotNull())


def named(value: Column, use) -> Column:
    """An expression over a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# What makes a match depend on where the text begins or ends, or on what surrounds it.
POSITIONAL = re.compile(r"[\^$]|\\[AZzGB]|\(\?[=!<]")


def scan_rules(df: DataFrame, keys: Sequence[str], text: str, rules: Sequence[ScanRule]) -> DataFrame:
    """Every match of every rule, line by line: rule, severity, line, column and the trimmed line.

    One pass over a text names the rules whose literals it holds; only these are
    tried, as rows of (text, rule) with the pattern as a value, so neither the
    plan nor the time of a text without hits grows with the rules. A rule that
    matches nowhere in a text matches in none of its lines, unless its pattern
    looks at line ends. Texts are cut into lines where they lie; nothing is
    shuffled.
    """
    names = ["__rule_id", "__severity", "__pattern", "__positional"]
    if not rules:
        rules = [ScanRule("none", "(?!)", "low")]
    wanted = [frozenset([r.literal.lower()]) if r.literal and r.literal.isascii() else required_literals(r.pattern) for r in rules]
    known = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, (
        r.id, r.severity.lower(), r.pattern, bool(POSITIONAL.search(r.pattern))))]) for r in rules])
    line, pattern = F.col("__line"), F.col("__pattern")
    tried = df.select(*keys, text, F.explode(candidates(F.col(text), wanted)).alias("__number")).select(
        *keys, text, F.get(known, "__number").alias("__rule")).select(*keys, text, "__rule.*")
    lines = tried.where(F.col("__positional") | F.rlike(F.col(text), pattern)).select(
        *keys, *names[:3], F.posexplode(F.split(text, "\n")).alias("__no", "__line")).where(F.rlike(line, pattern))
    found = lines.select(*keys, *names[:2], F.col("__no"), line, F.inline(_starts(line, pattern)))
    return found.select(
        *keys, F.col("__rule_id").alias("rule_id"), F.col("__severity").alias("severity"), (F.col("__no") + 1).alias("line"),
        "column", "match", F.trim(line).alias("evidence"))


def drop_rules(findings: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return findings.where(~F.col("rule_id").isin(*excluded)) if excluded else findings


def _counts() -> list[Column]:
    def of(s: str) -> Column:
        return F.count_if(F.col("severity") == s).alias(s)

    return [F.count("*").alias("findings"), of("low"), of("medium"), of("high"), of("critical")]


def _penalty(table: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for severity, points in table.items():
        total = total + F.col(severity) * points
    return total


def finding_score(findings: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts by severity, score 0 to 100 and risk."""
    out = findings.groupBy(*by).agg(*_counts())
    return out.withColumn("score", clamp(100.0 - _penalty(FINDING_PENALTY))).withColumn("risk", 100.0 - F.col("score"))


def grade_advisories(
    findings: DataFrame, ignored: Sequence[str] = (), max_cvss: float | None = None
) -> DataFrame:
    """Severity from CVSS; ignored packages, and scores over the maximum, are left out."""
    out = findings.withColumn("severity", ladder_at_least(F.col("cvss"), CVSS, "low"))
    if ignored:
        out = out.where(~F.col("package").isin(*ignored))
    return out.where(F.col("cvss") <= max_cvss) if max_cvss else out


def advisory_score(graded: DataFrame, by: Sequence[str]) -> DataFrame:
    (top, top_extra), (next_, next_extra) = CVSS_EXTRA
    out = graded.groupBy(*by).agg(
        *_counts(), F.count_if(F.col("cvss") >= top).alias("__top"),
        F.count_if((F.col("cvss") >= next_) & (F.col("cvss") < top)).alias("__next"))
    extra = F.col("__top") * top_extra + F.col("__next") * next_extra
    return out.withColumn("score", clamp(100.0 - _penalty(ADVISORY_PENALTY) - extra)).withColumn(
        "risk", 100.0 - F.col("score")).drop("__top", "__next")


def advisory_advice(graded: DataFrame) -> DataFrame:
    """One piece of advice per package: how many findings, how urgent, and the first version that fixes one."""
    out = graded.groupBy("package").agg(
        F.count("*").alias("findings"), F.count_if(F.col("severity").isin("high", "critical")).alias("__hard"),
        F.min(F.when(F.coalesce("fixed_in", F.lit("")) != "", F.struct("seq", "fixed_in"))).alias("__first"))
    fixed = F.col("__first.fixed_in")
    return out.select(
        "package", "findings", F.when(F.col("__hard") > 0, "high").otherwise("medium").alias("severity"),
        fixed.alias("fixed_in"),
        F.when(fixed.isNotNull(), F.concat(F.lit("Update "), "package", F.lit(" to version "), fixed, F.lit(" or later")))
        .otherwise(F.concat(F.lit("Update "), "package", F.lit(" to a version that fixes the identified vulnerabilities")))
        .alias("fix"))
