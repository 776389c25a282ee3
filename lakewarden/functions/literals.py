"""Which of many patterns can match a text, told from one pass over it.

Of each pattern the literals are taken of which every match contains one. All
literals of all patterns go into one prefix tree, written as one expression
that reads a text once, whatever the number of patterns; the literals found
name the patterns that are worth a closer look. Texts and literals are compared
in lower case and only ASCII is used, so that a pattern may be named in vain
but is never left out.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from re import _constants as op, _parser as parser

from pyspark.sql import Column, functions as F

# Syntax that Java's engine reads otherwise than Python's parser: set algebra and free spacing.
OTHERWISE = re.compile(r"\[[^\]]*\[|&&|\(\?[a-zA-Z]*x|\\Q")
# Single characters that nearly every text holds.
COMMON = re.compile(r"[a-z0-9\s.,'-]")


def required_literals(pattern: str) -> frozenset[str] | None:
    """Lower-case literals of which every match contains at least one; None if there are none to be told."""
    if OTHERWISE.search(pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            parsed = parser.parse(pattern)
    except (re.error, Warning, OverflowError):
        return None
    return _best(_of_sequence(parsed))


def _best(choices: Iterable[frozenset[str]]) -> frozenset[str] | None:
    """The choice whose shortest literal is longest; of these the one with the fewest. Common characters tell nothing."""
    telling = [c for c in choices if not any(len(x) == 1 and COMMON.match(x) for x in c)]
    return max(telling, key=lambda c: (min(map(len, c)), -len(c), sorted(c)), default=None)


def _of_sequence(items) -> list[frozenset[str]]:
    """Every set of literals that the parts of a sequence call for, neighbouring characters joined."""
    out, run = [], ""
    for kind, value in [*items, (None, None)]:
        if kind is op.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if run:
            out.append(frozenset([run]))
            run = ""
        if kind is op.SUBPATTERN:
            out += _of_sequence(value[-1])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
            out += _of_sequence(value[2])
        elif kind is op.ATOMIC_GROUP:
            out += _of_sequence(value)
        elif kind is op.BRANCH:
            ways = [_best(_of_sequence(way)) for way in value[1]]
            if all(ways):
                out.append(frozenset().union(*ways))
    return out


def literal_tree(literals: Iterable[str]) -> str:
    """An expression that matches, where a literal begins, the longest one that begins there."""
    root: dict = {}
    for literal in literals:
        node = root
        for char in literal:
            node = node.setdefault(char, {})
        node[""] = {}

    def written(node: dict) -> str:
        ways = [re.escape(char) + written(node[char]) for char in sorted(node) if char]
        if "" in node:
            return f"(?:{'|'.join(ways)})?" if ways else ""
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    # One set of first characters rules out most places before any way is tried.
    first = "".join(f"\\x{ord(char):02x}" for char in sorted(root))
    return f"(?=[{first}])(?=({written(root)}))"


def candidates(text: Column, literals: Sequence[frozenset[str] | None]) -> Column:
    """Numbers of the patterns that may match ``text``; those without literals always may."""
    always = F.array(*[F.lit(i) for i, wanted in enumerate(literals) if wanted is None]).cast("array<int>")
    every = sorted(set().union(*[wanted for wanted in literals if wanted]))
    if not every:
        return always
    # A literal at a place stands for those it begins with as well.
    meant = {x: [i for i, wanted in enumerate(literals) if wanted and any(x.startswith(w) for w in wanted)] for x in every}
    numbers = F.create_map(*[c for x in every for c in (F.lit(x), F.array(*[F.lit(i) for i in meant[x]]))])
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(literal_tree(every)), F.lit(1)))
    return F.array_distinct(F.concat(always, F.flatten(F.transform(found, lambda x: numbers[x]))))
