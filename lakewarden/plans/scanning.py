"""Rule scans over the documents, and advisory findings."""

from __future__ import annotations

from lakewarden.operators import scanning as s
from lakewarden.operators.scanning import ScanRule
from lakewarden.plans.registry import query

RULES = (
    ScanRule("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "MEDIUM", literal="@"),
    ScanRule("key", r"(AKIA|ASIA)[A-Z0-9]{16}", "critical"),
    ScanRule("ipv4", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "low"),
    ScanRule("phone", r"\+?[0-9]{3}[- ][0-9]{3}[- ][0-9]{4}", "low"),
    ScanRule("secret", r"(password|secret|token)[ ]*[:=]", "high"),
    ScanRule("license", r"[Ll]icen[sc]e", "medium"),
    ScanRule("broken", r"([a-z", "high"),
)

FOUND = """
rules(rule_id, pattern, severity) as (values """ + ", ".join(
    f"('{r.id}', '{r.pattern}', '{r.severity.lower()}')" for r in RULES if r.id != "broken") + """),
lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line_text, unnest(range(1, 1 + len(string_split(text, chr(10))))) as line from documents),
hits as (
  select doc_id, rule_id, severity, line, line_text, regexp_extract_all(line_text, pattern) as m, string_split_regex(line_text, pattern) as b
  from lines, rules where regexp_matches(line_text, pattern)),
found as (
  select doc_id, rule_id, severity, line, m[i] as match
    , 1 + list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as col
  from (select *, unnest(range(1, 1 + len(m))) as i from hits))"""


def found(t):
    rules = s.usable_rules(t.spark, RULES)
    return s.scan_rules(t.documents.select("doc_id", "text"), ["doc_id"], "text", rules)


@query("rule_scan", sql="with " + FOUND + """
select doc_id, rule_id, severity, cast(line as int) as line, cast(col as int) as "column", match from found""")
def rule_scan(t):
    return found(t).drop("evidence")


@query("finding_filter", sql="with " + FOUND + """
select doc_id, rule_id, cast(line as int) as line, match from found where rule_id not in ('email', 'license')""")
def finding_filter(t):
    return s.drop_rules(found(t), ["email", "license"]).select("doc_id", "rule_id", "line", "match")


@query("finding_score", sql="with " + FOUND + """,
n as (
  select doc_id, count(*) as findings, count(*) filter (severity = 'low') as low, count(*) filter (severity = 'medium') as medium
    , count(*) filter (severity = 'high') as high, count(*) filter (severity = 'critical') as critical from found group by 1)
select *, cast(greatest(0, 100 - 0.5 * low - 2 * medium - 5 * high - 10 * critical) as double) as score
  , cast(100 - greatest(0, 100 - 0.5 * low - 2 * medium - 5 * high - 10 * critical) as double) as risk from n""")
def finding_score(t):
    return s.finding_score(found(t), ["doc_id"])


GRADED = """
graded as (
  select *, case when cvss >= 9 then 'critical' when cvss >= 7 then 'high' when cvss >= 4 then 'medium' else 'low' end as severity
  from findings where package <> 'view_1' and cvss <= 9.5)"""


def graded(t):
    return s.grade_advisories(t.findings, ignored=["view_1"], max_cvss=9.5)


@query("advisory_score", views=("findings",), sql="with " + GRADED + """,
n as (
  select package, count(*) as findings, count(*) filter (severity = 'low') as low, count(*) filter (severity = 'medium') as medium
    , count(*) filter (severity = 'high') as high, count(*) filter (severity = 'critical') as critical from graded group by 1),
x as (select *, cast(greatest(0, 100 - low - 3 * medium - (8 + 2) * high - (15 + 5) * critical) as double) as score from n)
select *, 100 - score as risk from x""")
def advisory_score(t):
    return s.advisory_score(graded(t), ["package"])


@query("advisory_advice", views=("findings",), sql="with " + GRADED + """,
n as (
  select package, count(*) as findings, case when count(*) filter (severity in ('high', 'critical')) > 0 then 'high' else 'medium' end as severity
    , min_by(fixed_in, seq) filter (fixed_in is not null) as fixed_in from graded group by 1)
select *, case when fixed_in is not null then 'Update ' || package || ' to version ' || fixed_in || ' or later'
  else 'Update ' || package || ' to a version that fixes the identified vulnerabilities' end as fix
from n""")
def advisory_advice(t):
    return s.advisory_advice(graded(t))
