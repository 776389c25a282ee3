"""Small tables with odd rows, shared by the tests of this folder."""

import pytest

# Null, empty, blank and long texts, repeated rows, and columns whose names clash with those the operators make.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One  two"), (6, "one two"), (7, "one two"), (8, "x " * 3000),
    (9, "ab" * 3000), (10, "a b c d e f g h i j " * 12), (11, "a b c d e f g h i j " * 12 + "k"), (12, "naïve 😀 ﬁn " * 40),
]


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(pairs=ODD, partitions=3):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(partitions)

    return make


@pytest.fixture
def clashing(docs):
    """The odd rows with further columns named like the ones that operators make."""
    names = ("text_hash", "maybe", "fp", "mix", "piece", "rank", "before", "block", "seed", "run", "first", "score", "ids", "Sha", "h")
    df = docs()
    for name in names:
        df = df.withColumn(name, df["lang"])
    return df
