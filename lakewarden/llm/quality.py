"""Quality rules by weak supervision.

Each rule looks at one measure of a text and votes "good", "bad" or abstains.
No rule decides: expectation maximisation over the votes of all documents
estimates how often each rule says what of good and of bad texts, and a text is
kept if its posterior probability of being good reaches a threshold.

* Votes. A rule's measure beyond a published limit is a bad vote, well within
  it a good one, and anything between is an abstention; so is a measure that the
  text does not have (shares of no lines, say).
* Estimation. Documents are counted by their pattern of votes in Spark, over
  all rows; at most 3 to the power of the rules patterns reach the driver,
  however many documents there are. The first guess is the verdict that this
  replaces, all rules must pass. Each round counts the votes by class, then
  takes the posteriors anew.
* Verdict. The posterior is a sum of one weight per vote, so it is a Column.

Two limits stay absolute whatever the posterior (``base_failed``): fewer than
50 words, or over half the words in three-word windows that repeat.

Defined cases: a null text counts as empty and has no words, so it fails the
base; rows without doc_id and repeated rows are each judged and counted; lines
are what newlines separate, and equal only with all their spaces; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.llm.common import settle, spare, table, texts

ABSTAIN, GOOD, BAD = 0, 1, 2
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words
KEPT_FROM = 0.5     # posterior probability
ROUNDS = 100        # of expectation maximisation
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_ended", "n_lettered", "n_different", "longest",
)
SYMBOLS = "#*$%&|<>"
LETTER = re.compile(r"[^\W\d_]")
ENDS = (b".", b"!", b"?", b'"', "”".encode(), "…".encode(), b")", b":", b";")


@dataclass(frozen=True)
class Rule:
    """Votes by the ratio of two measures, or by one alone: bad outside ``passes``, good inside ``sure``."""

    name: str
    part: str
    whole: str
    passes: tuple[float, float]
    sure: tuple[float, float]

    def vote(self, found: Column) -> Column:
        whole = found[self.whole] if self.whole else F.lit(1)
        ratio = found[self.part] / F.when(whole > 0, whole)
        return (
            F.when(ratio.isNull(), ABSTAIN).when(~ratio.between(*self.passes), BAD)
            .when(ratio.between(*self.sure), GOOD).otherwise(ABSTAIN)
        )


RULES = (
    Rule("symbols", "n_symbols", "n_words", (0, 0.1), (0, 0.01)),
    Rule("word length", "word_chars", "n_words", (3, 10), (4, 7)),
    Rule("lettered", "n_lettered", "n_words", (0.8, 1), (0.95, 1)),
    Rule("lines again", "n_dup_lines", "n_lines", (0, 0.3), (0, 0.05)),
    Rule("words again", "n_repeat_words", "n_words", (0, 0.3), (0, 0.05)),
    Rule("vocabulary", "n_different", "n_words", (0.1, 1), (0.3, 1)),
    Rule("ended", "n_ended", "n_lines", (0.3, 1), (0.8, 1)),
    Rule("longest word", "longest", "", (0, 100), (0, 40)),
    Rule("length", "n_words", "", (LEAST_WORDS, 100_000), (2 * LEAST_WORDS, 20_000)),
)


def repeated_words(ids: np.ndarray, different: int) -> int:
    """Words in three-word windows that the text has twice or more."""
    if len(ids) < 4:
        return 0
    _, pairs = np.unique(ids[:-1] * different + ids[1:], return_inverse=True)
    _, back, count = np.unique(pairs[:-1] * different + ids[2:], return_inverse=True, return_counts=True)
    hit = count[back] > 1
    covered = np.zeros(len(ids), bool)
    for step in range(3):
        covered[step : step + len(hit)] |= hit
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the white space asked for
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    per_word = np.bincount(ids, minlength=len(known))
    shown = [w.decode() for w in known]
    lettered = np.array([bool(LETTER.search(w)) for w in shown], bool)
    seen: set[bytes] = set()
    lines = again = ended = 0
    for line in raw.split(b"\n"):
        last = line.rstrip()
        if last:
            lines += 1
            again += line in seen
            seen.add(line)
            ended += last.endswith(ENDS)
    return (
        len(words), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, SYMBOLS)), again,
        repeated_words(ids, len(known)), lines, ended, int(per_word[lettered].sum()), len(known), max(map(len, shown), default=0),
    )


def measure_column(text: Column) -> Column:
    """A struct of the measures of a text."""

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measure(column: pd.Series) -> pd.DataFrame:
        found = np.array([measures(t) for t in column], np.int64).reshape(-1, len(MEASURES))
        return pd.DataFrame(dict(zip(MEASURES, found.T)))

    return measure(F.coalesce(text, F.lit("")))


def votes_column(found: Column) -> Column:
    """The pattern of votes on a struct of measures, one digit per rule."""
    return F.concat(*[rule.vote(found).cast("string") for rule in RULES])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, measures and votes of every text; one pass, no shuffle."""
    found = texts(docs).select("doc_id", measure_column(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*", votes_column(F.col("found")).alias("votes"))


@dataclass(frozen=True)
class Model:
    """Share of good texts, and P(vote | class) by class (bad, good), rule and vote."""

    prior: float
    chance: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) of patterns given as rows of votes."""
        each = np.log(self.chance[1] / self.chance[0])
        odds = np.log(self.prior / (1 - self.prior)) + each[np.arange(votes.shape[1]), votes].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def column(self, votes: Column) -> Column:
        """The same as a Column of the pattern."""
        odds = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for rule, own in enumerate(np.log(self.chance[1] / self.chance[0])):
            digit = F.substring(votes, rule + 1, 1)
            odds = odds + F.when(digit == str(GOOD), float(own[GOOD])).when(digit == str(BAD), float(own[BAD])).otherwise(float(own[ABSTAIN]))
        return 1 / (1 + F.exp(-odds))

    def accuracies(self) -> np.ndarray:
        """Of each rule the share of right votes among those it casts, over both classes."""
        weight = np.array([1 - self.prior, self.prior])[:, None]
        cast = weight * (self.chance[:, :, GOOD] + self.chance[:, :, BAD])
        right = (1 - self.prior) * self.chance[0, :, BAD] + self.prior * self.chance[1, :, GOOD]
        return right / cast.sum(axis=0)


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model of vote patterns (patterns x rules) that occur so often."""
    good = np.where((votes == BAD).any(axis=1), 0.1, 0.9)
    model = Model(0.5, np.full((2, votes.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([count * (1 - good), count * good])
        chance = np.stack([weight @ (votes == v) for v in (ABSTAIN, GOOD, BAD)], axis=2) + 0.5
        chance /= chance.sum(axis=2, keepdims=True)
        model = Model(float((weight[1].sum() + 1) / (count.sum() + 2)), chance)
        before, good = good, model.posterior(votes)
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return model


def fitted(patterns: DataFrame) -> Model:
    """The model of all rows, from their patterns of votes."""
    seen = sorted(patterns.groupBy("votes").count().collect())
    votes = np.array([[int(v) for v in r["votes"]] for r in seen], int).reshape(len(seen), len(RULES))
    return estimate(votes, np.array([r["count"] for r in seen], float))


def base_failed(n: Column, again: Column) -> Column:
    return (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)


def judged(docs: DataFrame) -> DataFrame:
    """Every document with its measures, votes, base_failed, quality (posterior) and kept."""
    found = settle(measured(docs), "quality")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return found.withColumn("base_failed", failed).withColumn("quality", fitted(found).column(F.col("votes"))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEPT_FROM))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    model = fitted(settle(measured(docs).select("votes"), "quality-votes"))
    name = spare(docs, "found")
    shown = docs.withColumn(name, measure_column(F.col("text")))
    own = F.col(name)
    good = model.column(votes_column(own)) >= KEPT_FROM
    return shown.where(~base_failed(own["n_words"], own["n_repeat_words"]) & good).drop(name)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


QUERIES = {"op11_quality": op11_quality}
ORACLES: dict[str, str] = {}
