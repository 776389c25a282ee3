"""Toxicity by weak supervision.

Many voters look at a text: words and patterns, each saying "toxic", "clean" or
nothing. A generative label model learns from their agreement how accurate each
is and which ones say the same thing, and gives every training text a
probability of being toxic. A linear classifier on the voters' findings is then
trained on those probabilities and scores all texts.

* Voters. A fixed list of insults; words and beginnings of words that training
  texts labelled toxic have far more often than others; signs, shouting and
  address patterns; and the absence of all of them.
* Label model. Naive Bayes with a class prior, fitted by expectation
  maximisation; the given label of a training text is one more voter, which the
  model may find to be wrong. Voters whose findings still correlate within a
  class share their weight, so that saying the same twice counts once.
* Classifier. Logistic regression on the voters, fitted to the posteriors by
  Newton steps with a ridge.

Words are told apart as a reader would: in lower case, between characters that
are no letters or digits, also with digits and signs written for letters.

Fitting uses at most ``most`` labelled rows, those of smallest hash, and never
a row held out. Scoring reads every whole text once, without a shuffle.

Defined cases: a null text counts as empty and is scored; null labels and
labels of unknown documents train nothing; without training rows the fixed
lists alone vote, with even odds; a row without doc_id is scored and not held
out; several labels of one document count as toxic if one of them does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakewarden.llm.common import table, texts

MOST_ROWS = 10_000   # labelled rows that training may use
LEARNED = 40         # words and beginnings that training may add
BEGINNINGS = range(3, 8)  # their lengths in letters
LEAST_DOCS = 8       # kinds of toxic training texts that a learned word must be in
THRESHOLD = 0.3
DENSE = 60           # words per hit from which hits are dense
ROUNDS = 50          # of expectation maximisation

INSULTS = """idiot moron stupid dumb fool loser scum trash garbage worthless pathetic disgusting clown imbecile
cretin jerk bastard bitch whore slut retard retarded pig vermin filth filthy scumbag degenerate subhuman freak
kill hate shut ugly hideous asshole bullshit crap damn hell fuck fucking shit dick cunt idiota imbécile
connard salaud ordure idiote dummkopf arschloch abschaum trottel estúpido imbécil basura escoria""".split()

WORD = re.compile(r"[^\W_]+")
SIGNS = re.compile(r"[013457@$]")
LOOKS = str.maketrans("013457@$", "oieastas")
PATTERNS = {
    "address": r"\byou(?:'re| are| r)\b[^.!?\n]{0,40}\b(?:{insults})\b",
    "wish": r"\b(?:go|should|hope you)\b[^.!?\n]{0,20}\bdie\b",
    "exclaims": r"!{2,}",
    "swearsigns": r"(?<!\S)(?=[@#$%&*!]*[@#$%&*][@#$%&*!]*[!?.]?(?!\S))[@#$%&*!]{4,}",
}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Voters:
    """What is looked for in a text; ``find`` gives one 0/1 finding per name."""

    words: list[str]  # a beginning ends in "*"

    def __post_init__(self):
        self.at = {w: i for i, w in enumerate(self.words)}
        insults = "|".join(sorted(INSULTS))
        self.patterns = [re.compile(p.replace("{insults}", insults)) for p in PATTERNS.values()]
        self.names = [*self.words, *PATTERNS, "shouts", "disguised", "any", "several", "dense", "none"]
        self.known = frozenset(w for w in self.words if not w.endswith("*"))
        self.starts = {n: frozenset(w[:-1] for w in self.words if w.endswith("*") and len(w) == n + 1) for n in BEGINNINGS}

    def hits(self, words: set[str]) -> tuple[set[str], int]:
        """The terms met, and how many different words of the text are among them."""
        whole = self.known.intersection(words)
        found, count = set(whole), len(whole)
        for n, own in self.starts.items():
            if own:
                met = [w[:n] for w in words if w[:n] in own and len(w) > n]
                found.update(w + "*" for w in met)
                count += len(met)
        return found, count

    def find(self, text: str) -> np.ndarray:
        out = np.zeros(len(self.names), np.float32)
        low = text.lower()
        words = set(WORD.findall(low))
        found, count = self.hits(words)
        for word in found:
            out[self.at[word]] = 1
        base = len(self.words)
        if found or "you" in low or "die" in low:
            out[base] = bool(self.patterns[0].search(low))
            out[base + 1] = bool(self.patterns[1].search(low))
        if "!!" in low:
            out[base + 2] = len(self.patterns[2].findall(low)) >= 3
        out[base + 3] = bool(self.patterns[3].search(low))
        out[base + 4] = len(text) >= 20 and text.upper() == text and low != text
        if SIGNS.search(low):
            out[base + 5] = bool(self.known.intersection(WORD.findall(low.translate(LOOKS))) - found)
        out[base + 6] = count >= 1
        out[base + 7] = count >= 2
        out[base + 8] = count * DENSE >= len(words) and count > 0
        out[base + 9] = not out[: base + 9].any()
        return out


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    bias: float
    accuracies: dict[str, float]

    def score(self, text: str) -> float:
        z = float(self.voters.find(text) @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def label_model(votes: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of "toxic", each voter's P(finding | class), and the share of its weight that it keeps.

    ``votes`` is texts x voters (0/1), ``label`` the given labels. Starts from
    the labels; the second half of the rounds knows which voters correlate.
    """
    n, k = votes.shape
    post = np.where(label == 1, 0.9, 0.02)
    share = np.ones(k)
    chance = np.full((2, k), 0.5)
    for step in range(rounds):
        prior = (post.sum() + 1) / (n + 2)
        for c, weight in enumerate((1 - post, post)):
            chance[c] = (weight @ votes + 0.5) / (weight.sum() + 1)
        given = np.array([(w @ label + 1) / (w.sum() + 2) for w in (1 - post, post)])
        if step == rounds // 2:
            share = 1 / correlated(votes, post, chance)
        odds = np.log(prior / (1 - prior)) + np.where(
            label == 1, np.log(given[1] / given[0]), np.log((1 - given[1]) / (1 - given[0]))
        )
        on, off = np.log(chance[1] / chance[0]), np.log((1 - chance[1]) / (1 - chance[0]))
        odds = odds + votes @ (share * (on - off)) + (share * off).sum()
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, chance, share


def correlated(votes: np.ndarray, post: np.ndarray, chance: np.ndarray, least: float = 0.3) -> np.ndarray:
    """How many voters say about the same as each, itself included, beyond what the class explains."""
    rest = votes - (post[:, None] * chance[1] + (1 - post[:, None]) * chance[0])
    spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
    bond = np.abs(rest.T @ rest) / len(votes) / np.outer(spread, spread)
    return 1 + np.where(bond >= least, bond, 0).sum(axis=1) - np.where(bond.diagonal() >= least, bond.diagonal(), 0)


def linear(votes: np.ndarray, post: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression to soft labels; the last weight is the bias."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-9), x.T @ (post - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """At most so many labelled rows that are not held out: text, label; chosen by the hash of doc_id."""
    own = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return texts(docs).join(own, "doc_id").select("doc_id", "text", (F.col("toxic") == 1).cast("int").alias("label"))


def learned_words(rows: DataFrame, most: int, least: int) -> list[str]:
    """Words that toxic training texts have more often than others beyond chance, strongest first.

    Texts are counted by the smallest hash of their stretches of four words, so
    that copies and most near copies of one text count once.
    """
    every = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    stretches = F.transform("every", lambda w, i: F.xxhash64(F.array_join(F.slice(F.col("every"), i + 1, 4), " ")))

    def beginnings(n: int) -> Column:
        return F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*")))

    terms = F.array_union("words", F.array_distinct(F.flatten(F.array(*[beginnings(n) for n in BEGINNINGS]))))
    held = rows.select("label", every.alias("every")).select(
        "label", F.array_distinct("every").alias("words"), F.array_min(stretches).alias("kind")
    )
    totals = held.groupBy("label").agg(F.count_distinct("kind").alias("n")).collect()
    kinds = {r["label"]: r["n"] for r in totals}
    pairs = held.select("label", "kind", F.explode(terms).alias("word")).distinct()
    counts = pairs.groupBy("word").agg(F.sum("label").alias("t"), F.count("*").alias("n")).where(F.col("t") >= least)
    toxic, clean = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    # Lower end of the log odds' range: a word in few texts must be told apart more clearly.
    low = F.log(toxic / (kinds.get(1, 0) + 1.0)) - F.log(clean / (kinds.get(0, 0) + 1.0)) - 3 * F.sqrt(1 / toxic + 1 / clean)
    strong = counts.withColumn("low", low).where("low > 1")
    found = strong.orderBy(F.desc("low"), F.length("word"), "word").limit(20 * most).collect()
    whole = [(r["word"], r["t"]) for r in found if not r["word"].endswith("*")]
    out: list[str] = []
    for word, t in ((r["word"], r["t"]) for r in found):
        start = word[:-1] if word.endswith("*") else None
        one_word = start and any(w.startswith(start) and 2 * n >= t for w, n in whole)  # the beginning of one word only
        covered = any(w.endswith("*") and word.startswith(w[:-1]) for w in out)
        if len(out) < most and not one_word and not covered:
            out.append(word)
    return out


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """The model learned from the labelled rows that are not held out."""
    rows = training_rows(docs, labels, most)
    extra = learned_words(rows, LEARNED, LEAST_DOCS)
    voters = Voters(list(dict.fromkeys([*INSULTS, *extra])))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.packbits(voters.find(t).astype(bool)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["doc_id", "votes", "label"])

    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("votes binary, label int")])
    seen = sorted(rows.mapInArrow(look, schema).collect())  # some bits a row, `most` rows
    if not seen:
        weights = np.array([1.0] * (len(voters.names) - 1) + [-2.0])
        return Model(voters, weights, 0.0, {})
    votes = np.array([np.unpackbits(np.frombuffer(r["votes"], np.uint8))[: len(voters.names)] for r in seen], float)
    label = np.array([r["label"] for r in seen])
    post, chance, _ = label_model(votes, label)
    w = linear(votes, post)
    accuracies = dict(zip(voters.names, (chance[1] / (chance[0] + chance[1])).round(4).tolist()))
    return Model(voters, w[:-1], float(w[-1]), accuracies)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([model.score(t) for t in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    rows = texts(docs)
    out = rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""

    @F.pandas_udf("boolean")
    def clean(column):
        return column.map(lambda t: model.score(t or "") < THRESHOLD)

    return docs.where(clean(F.coalesce(F.col("text"), F.lit(""))))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
