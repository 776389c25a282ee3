r"""Secret scans by the cost of guessing a value.

Values in credential contexts are cut into words, dates, repeats, keyboard
walks and brute-force stretches so that guessing the parts costs least
(dynamic programming over the value's positions). A value whose cheapest cut
still costs more than a threshold is a secret; "changeme2020" is not.

The base kinds (assign, access, hex) follow fixed patterns and lengths and
always stay, whatever their cost. The method adds kind ``secret``: values after
further credential names, and shorter ones, that are dear to guess and overlap
no base span.

A context's pattern is tried only on texts that hold one of its words. The
cutting takes time in proportion to the value's length: a word or date is
looked for at its few possible lengths, a repeat or walk is taken from any
place in it to its end.

Defined cases: a null text counts as empty and gives zero counts and empty
lists; null doc_ids and repeated rows each give their own row.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from lakewarden.llm.common import table, texts

LEAST_COST = 10.0  # decimal digits of guesses from which a value is a secret
LEAST_LENGTH = 8   # of a value that the method may add

# Fixed patterns of the base kinds; letters of the names in either case.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINT = re.compile(r"(?ai:passw|secret|token|api_?key)")
BASE = ("assign", "access", "hex")

# Further credential names of the method.
CONTEXT = re.compile(
    r"""(?ai:passphrase|password|passwd|pwd|secret|token|bearer|api_?key|access_?key|private_?key|credential|auth)"""
    r"""["']?\x20*(?:[:=]|\x20is\x20)\x20*["']?([A-Za-z0-9+/_.=!@#$%^&*-]{8,})"""
)
CONTEXT_HINT = re.compile(r"(?ai:pass|pwd|secret|token|bearer|key|credential|auth)")

# Words that guessers try first, most common first.
WORDS = """password admin welcome login master monkey dragon letmein qwerty iloveyou princess sunshine football
shadow superman batman trustno secret hello freedom whatever ninja mustang access flower passw0rd changeme default
example sample test temp guest user root server public private token apikey api key none null true false placeholder
your insert value here demo dummy replace todo xxx company summer winter spring autumn monday friday january""".split()

ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LOOKS = str.maketrans("013457@$!", "oleastasi")  # digits and signs written for letters
DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])(?:\1(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
DATE_COST = math.log10(365.0 * 120)
YEAR_COST = math.log10(120.0)


class GuessCost:
    """Least cost, in decimal digits of guesses, of a value over all its cuts."""

    def __init__(self, words: list[str] = WORDS):
        self.cost = {w: math.log10(i + 2) for i, w in reversed(list(enumerate(words)))}
        self.lengths = sorted({len(w) for w in self.cost})
        self.next = {}
        for row in ROWS:
            for a, b in zip(row, row[1:]):
                self.next.setdefault((a, b), (row, 1))
                self.next.setdefault((b, a), (row, -1))

    def _run_ends(self, value: str) -> tuple[list[int], list[int]]:
        """For each place the end of the repeat and of the walk that it is in."""
        n = len(value)
        repeat, walk = list(range(1, n + 1)), list(range(1, n + 1))
        for i in range(n - 2, -1, -1):
            if value[i] == value[i + 1]:
                repeat[i] = repeat[i + 1]
            step = self.next.get((value[i], value[i + 1]))
            if step is not None:
                goes_on = i + 2 < n and self.next.get((value[i + 1], value[i + 2])) == step
                walk[i] = walk[i + 1] if goes_on else i + 2
        return repeat, walk

    def __call__(self, value: str) -> float:
        low = value.lower()
        plain = low.translate(LOOKS)
        n = len(value)
        repeat, walk = self._run_ends(low)
        classes = 10 * bool(re.search(r"[0-9]", value)) + 26 * bool(re.search(r"[a-z]", value)) + 26 * bool(re.search(r"[A-Z]", value))
        brute = math.log10(max(10, classes + 10 * bool(re.search(r"[^0-9A-Za-z]", value))))
        best = [0.0] + [math.inf] * n

        def reach(end: int, cost: float) -> None:
            if cost < best[end]:
                best[end] = cost

        for i in range(n):
            here = best[i]
            reach(i + 1, here + brute)
            if repeat[i] - i >= 3:
                reach(repeat[i], here + brute + math.log10(repeat[i] - i))
            if walk[i] - i >= 3:
                reach(walk[i], here + 1.3 + math.log10(walk[i] - i))
            for length in self.lengths:
                if i + length > n:
                    break
                part = low[i : i + length]
                cost = self.cost.get(part)
                if cost is None:
                    cost = self.cost.get(plain[i : i + length])
                    cost = cost + 1.0 if cost is not None else None  # the looks-alike ones come later
                if cost is not None:
                    raw = value[i : i + length]
                    reach(i + length, here + cost + (0.0 if raw == part else 0.3 if raw.istitle() or raw.isupper() else 1.0))
            match = DATE.match(low, i)
            if match:
                reach(match.end(), here + (DATE_COST if len(match.group()) > 4 else YEAR_COST))
        return best[n]


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of the base kinds in order."""
    spans = []
    if ASSIGN_HINT.search(text):
        spans += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def added_spans(text: str, base: list[tuple[int, int, str, int]], cost: GuessCost, least: float) -> list[tuple[int, int, str, int]]:
    """Dear values after credential names that overlap no base span."""
    if not CONTEXT_HINT.search(text):
        return []
    out, at, stop = [], 0, 0
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        while at < len(base) and base[at][0] < end:  # starts grow on both sides
            stop = max(stop, base[at][3])
            at += 1
        if start >= stop and cost(m.group(1)) >= least:
            out.append((start, 3, "secret", end))
    return out


def _joined(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, top_cost double"


def find(docs: DataFrame, least_cost: float = LEAST_COST, words: list[str] = WORDS) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, the dearest value's cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(words)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                added = added_spans(text, base, cost, least_cost)
                values = [ASSIGN.match(text, s[0]).group(2) for s in base if s[2] == "assign"] + [text[s[0] : s[3]] for s in added]
                row = [sum(s[2] == k for s in base) for k in BASE]
                row += [hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), max(map(cost, values), default=0.0)]
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "top_cost"],
            )

    rows = texts(docs)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(FOUND)]))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op3_secrets": op3_secrets}
ORACLES: dict[str, str] = {}
