"""Many rules in one pass, against every rule tried alone."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from lakewarden.functions.literals import candidates, literal_tree, required_literals
from lakewarden.operators.scanning import ScanRule, scan_rules


@pytest.mark.parametrize("pattern, literals", [
    ("(password|secret|token)[ ]*[:=]", {"password", "secret", "token"}), ("[Ll]icen[sc]e", {"icen"}), ("AB+cd", {"cd"}),
    ("a*b?", None), ("(?:foo)?bar", {"bar"}), ("(foo|b*)x", None), ("(?i)KEY", {"key"}), ("(ab){2,}", {"ab"}),
    ("(?=secret)s", None), ("[a-z&&[^b]]cc", None), ("([a-z", None), (r"\p{Alpha}key", None), ("@", {"@"}), ("ü+key", {"key"})])
def test_literals_of_a_pattern(pattern, literals):
    assert required_literals(pattern) == (None if literals is None else frozenset(literals))


def test_no_pattern_is_left_out():
    """Whatever a random pattern matches holds one of its literals."""
    rng, told = random.Random(4), 0

    def pattern(depth):
        parts = []
        for _ in range(rng.randint(1, 4)):
            part = rng.choice(["a", "B", "c", "ab", "[ab]", "d", "."]) if depth == 0 or rng.random() < 0.6 else (
                f"({'|'.join(pattern(depth - 1) for _ in range(rng.randint(1, 3)))})")
            parts.append(part + rng.choice(["", "", "", "?", "*", "+", "{2}", "{0,1}"]))
        return "".join(parts)

    for _ in range(400):
        p = pattern(2)
        wanted = required_literals(p)
        told += wanted is not None
        for text in ("".join(rng.choice("aBcdD ") for _ in range(12)) for _ in range(40)):
            if wanted and re.search(p, text):
                assert any(w in text.lower() for w in wanted), (p, text)
    assert told > 50


def test_candidates_are_all_that_occur(rows):
    """Literals within, at the start of and across each other are all found."""
    rng = random.Random(5)
    words = ["key", "keys", "eyst", "stop", "key_", "a.b", "[x]", "yk"]
    texts = ["".join(rng.choice(["key", "s", "t", "top", "_", "a.b", "[x]", "E", "Y", "k", " "]) for _ in range(9)) for _ in range(300)]
    df = rows([(i, t) for i, t in enumerate([*texts, "", None])], "id int, text string")
    got = {r.id: set(r.n) for r in df.select("id", candidates(F.col("text"), [frozenset([w]) for w in words] + [None]).alias("n"))
           .where("n is not null").collect()}
    for i, t in enumerate([*texts, ""]):
        assert got[i] == {n for n, w in enumerate(words) if w in t.lower()} | {len(words)}
    assert re.search(literal_tree(words), "the keys").group(1) == "keys"


def test_a_hundred_rules(rows):
    rng = random.Random(6)
    stems = [f"{a}{b}{n}" for n in range(5) for a in ("key", "tok", "pass", "id") for b in ("en", "word", "_x", "ring", "")]
    rules = [ScanRule(f"r{i}", rf"{stem}[ ]*[:=]\s*\w+" if i % 3 else rf"^{stem}\b", "HIGH") for i, stem in enumerate(stems)]
    rules += [ScanRule("digits", r"\d{3}-\d{4}", "low"), ScanRule("given", r"[sz]ecret", "low", literal="ecret")]
    texts = ["\n".join(" ".join(rng.choice([*stems, "= x", ":y9", "555-1234", "zecret", "plain", "words"]) for _ in range(rng.randint(0, 6)))
                       for _ in range(rng.randint(1, 4))) for _ in range(500)]
    df = rows([(i, t) for i, t in enumerate([*texts, "", None])], "id int, text string")
    want = {(i, r.id, no, m.start() + 1, m.group()) for i, t in enumerate(texts) for no, line in enumerate(t.split("\n"), 1)
            for r in rules for m in re.finditer(r.pattern, line)}
    found = scan_rules(df, ["id"], "text", rules)
    assert as_set(found.select("id", "rule_id", "line", "column", "match")) == want and len(want) > 300
    assert found.columns == ["id", "rule_id", "severity", "line", "column", "match", "evidence"]
    assert scan_rules(df, ["id"], "text", []).count() == 0 and scan_rules(df.limit(0), ["id"], "text", rules).count() == 0


def test_the_plan_does_not_grow_with_the_rules(rows):
    """Patterns are values of rows: per rule there is no expression of its own after the first pass."""
    df = rows([(1, "x")], "id int, text string")

    def regex_nodes(n):
        found = scan_rules(df, ["id"], "text", [ScanRule(f"r{i}", f"name{i}=", "low") for i in range(n)])
        return found._jdf.queryExecution().optimizedPlan().toString().lower().count("rlike")

    assert regex_nodes(100) == regex_nodes(5)
