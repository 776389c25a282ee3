"""Quality rules: base measures against a plain count, the label model against a second one, verdicts against labels."""

import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

import brute
from conftest import SF
from lakewarden.llm import quality
from odd import ODD, clashing, docs  # noqa: F401


def plain(text):
    text = text or ""
    words = brute.WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    again = {p + s for p in range(len(words) - 2) if windows[tuple(words[p : p + 3])] > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def base(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, *r[1:7]) for r in df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())


def drawn(seed, n=60):
    draw = random.Random(seed)
    words = ["a", "b", "#c", "ï|", "d e", "f g", "x" * 50]
    gaps = [" ", "\n", "  ", "\t", " \n", "\r\n", "\x0b"]
    return [(i, "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.choice([0, 2, 3, 4, 5, 30, 200])))) for i in range(n)]


def test_measures(docs, clashing):
    rows = ODD + [(100 + i, t) for i, t in drawn(3)] + [(None, "a b c\na b c"), (5, "again")]
    assert base(quality.judged(docs(rows))) == sorted((-1 if i is None else i, *plain(t)) for i, t in rows)
    assert base(quality.judged(clashing)) == sorted((i, *plain(t)) for i, t in ODD)
    assert quality.judged(docs([])).count() == 0 and quality.keep_good(docs([])).count() == 0


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert base(quality.op11_quality(spark, SF)) == sorted((i, *plain(t)) for i, t in rows)


def second(votes, rounds):
    """The same model told once more, document by document, with dictionaries."""
    good = [0.1 if 2 in v else 0.9 for v in votes]
    for _ in range(rounds):
        chance = {}
        for c in (0, 1):
            weight = [g if c else 1 - g for g in good]
            for r in range(len(votes[0])):
                tally = {v: 0.5 + sum(w for w, row in zip(weight, votes) if row[r] == v) for v in (0, 1, 2)}
                for v in tally:
                    chance[c, r, v] = tally[v] / sum(tally.values())
        prior = (sum(good) + 1) / (len(votes) + 2)
        out = []
        for row in votes:
            like = [np.prod([chance[c, r, v] for r, v in enumerate(row)]) for c in (0, 1)]
            out.append(prior * like[1] / (prior * like[1] + (1 - prior) * like[0]))
        good = out
    return good


def votes_of(n, seed):
    """Votes of rules with known accuracies, and the truth."""
    draw = np.random.default_rng(seed)
    truth = draw.random(n) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    casts = draw.random((n, len(right))) < 0.8
    good = np.where(draw.random((n, len(right))) < right, truth[:, None], ~truth[:, None])
    return np.where(casts, np.where(good, quality.GOOD, quality.BAD), quality.ABSTAIN), truth, right


def test_label_model_against_a_second_one():
    votes, _, _ = votes_of(200, 5)
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    got = quality.estimate(patterns, count, 7).posterior(votes)
    assert np.allclose(got, second(votes.tolist(), 7), atol=1e-9)


def test_label_model_finds_known_accuracies():
    votes, truth, right = votes_of(20_000, 6)
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, count, 500)
    assert np.abs(model.accuracies() - right).max() < 0.03 and abs(model.prior - 0.7) < 0.03
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.93


def test_a_document_may_fail_a_rule_and_stay(spark, docs):
    """Verdicts follow posteriors: rules that good texts fail often do not decide alone."""
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(3, 8)))
    text = lambda ended: "\n".join(" ".join(word() for _ in range(12)) + ("." if ended else "") for _ in range(10))
    rows = [(i, text(i % 2)) for i in range(60)] + [(100 + i, "\n".join([" ".join(f"{word()}###" for _ in range(12)) + "."] * 2 + [text(True)[:90]] * 3)) for i in range(20)]
    got = {r.doc_id: r.kept for r in quality.judged(docs(rows)).collect()}
    assert all(got[i] for i in range(60)) and not any(got[100 + i] for i in range(20))
    assert {r.doc_id for r in quality.keep_good(docs(rows)).collect()} == {i for i in got if got[i]}


def test_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.op11_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label")), "doc_id")
    rows = found.where("not base_failed").collect()
    bad, good = [r for r in rows if r.label == 0], [r for r in rows if r.label == 1]
    assert len(bad) > 10 and sum(not r.kept for r in bad) >= 0.95 * len(bad)
    assert sum(r.kept for r in good) >= 0.97 * len(good)
