"""Operators that look at each text alone: encoding, secrets, personal data, toxicity."""

import random
import struct
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import brute
from lakewarden.llm import byte_bpe, pii, secrets, toxicity
from odd import ODD, clashing, docs  # noqa: F401

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def mixture(parts, rows, most, seed):
    draw = random.Random(seed)
    return [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, most)))) for i in range(rows)]


def test_perfect_hash_finds_entries_and_nothing_else():
    table = byte_bpe.PerfectHash(RANKS)
    assert all(table.get(k) == v for k, v in RANKS.items())
    assert len([k for k in table.keys if k is not None]) == table.size == len(RANKS)
    assert table.get(b"no such entry") == -1
    assert byte_bpe.PerfectHash({}).get(b"a") == -1


def test_ids_are_those_of_the_library():
    own = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN, kept=50)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    parts = ["a", "the", " ", "  ", "\n", "é", "ß", "😀", "\x1c", "　", "\x85", "1", "½", "٣", "'s", "'ll", "!", "中文", "̀", "ing", "\0"]
    texts = [t for _, t in mixture(parts, 400, 60, 2)] + ["", "ab" * 800, " " * 900 + "x", "<|endoftext|>"]
    for text in texts:
        ids = own.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == other.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_bpe_of_odd_rows(spark, docs, clashing):
    shared = byte_bpe.production(spark)
    got = {r.doc_id: r for r in byte_bpe.digests(clashing, shared).collect()}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for i, text in ODD:
        ids = other.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == brute.sha(struct.pack(f"<{len(ids)}I", *ids))
        assert got[i].decoded_sha256 == brute.sha(text or "")
    assert byte_bpe.digests(docs([]), shared).count() == 0
    both = byte_bpe.decode(byte_bpe.encode(docs(), shared), shared)
    assert {r.doc_id: bytes(r.raw) for r in both.collect()} == {i: (t or "").encode() for i, t in ODD}
    assert byte_bpe.tokenised(docs(), shared).where("not intact").count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_secret_spans(docs, seed):
    parts = ["Password", "token", " ", "=", ":", '"', "'", "abcdef0123", "AKIA", "ABCDEFG", "secret", "api_key", "éS", "9f", "pwd", "K", "Zq8!x"]
    rows = mixture(parts, 600, 50, seed) + [(9001, None), (9002, "token=" + "a" * 20000), (9003, "token" * 2000)]
    got = {r.doc_id: r for r in secrets.find(docs(rows)).collect()}
    for i, text in rows:
        want = brute.secrets(text or "")
        assert got[i].base_sha256 == brute.sha(brute.joined(want))
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[2] == k for s in want) for k in secrets.BASE]
        assert set(brute.joined(want).split(",")) - {""} <= set(got[i].spans.split(","))


def test_guess_cost_takes_the_cheapest_cut():
    cost = secrets.GuessCost()
    weak = ("changeme2020", "password123", "qwertyuiop", "aaaaaaaaaaaaaaaa", "dragon19870412", "monkeymonkey")
    strong = ("24be64439e3e49cf46b2d7", "zX9kQ2mPw7", "Tr0ub4dor&3")
    assert max(map(cost, weak)) < secrets.LEAST_COST < min(map(cost, strong))
    assert cost("") == 0 and cost("x" * 50000) < 10


def test_weak_values_are_not_added(docs):
    rows = [(1, "pwd: changeme2020 ok"), (2, "pwd: zX9kQ2mPw7Lr ok"), (3, "secret = zX9kQ2mPw7Lr4"), (4, "bearer: aaaaaaaaaa")]
    got = {r.doc_id: r.spans for r in secrets.find(docs(rows)).collect()}
    assert got == {1: "", 2: "secret:5:17", 3: "assign:0:22", 4: ""}


@pytest.mark.parametrize("seed", range(2))
def test_personal_data(docs, seed, monkeypatch, spark):
    parts = ["a", "b.c", "@", "x@y.z", "_", "1", "2.", "10.20.30.", "+1", "+44 ", "(555)", " ", "-", "4111 1111 1111 1111", "é", "😀", "12"]
    rows = mixture(parts, 800, 40, seed) + ODD + [(9002, "1" * 30000), (9003, "a" * 30000 + "@"), (9004, "1." * 20000), (9005, "1 " * 20000)]
    rows = [(i + 20000 * n, t) for n, (i, t) in enumerate(rows)]
    monkeypatch.setattr(pii, "table", lambda *a: docs(rows))
    got = {r.doc_id: r for r in pii.op9_pii(spark, "").collect()}
    for i, text in rows:
        want = brute.pii(text or "")
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[2] == k for s in want) for k in brute.PII]
        assert got[i].base_sha256 == brute.sha(brute.joined(want))
        assert set(brute.joined(want).split(",")) - {""} <= set(got[i].spans.split(","))


def test_checksums_and_context(docs, monkeypatch, spark):
    rows = [
        (1, "pay to GB82 WEST 1234 5698 7654 32 now"), (2, "pay to GB83 WEST 1234 5698 7654 32 now"), (3, "my ssn 123-45-6789"),
        (4, "part 123-45-6789"), (5, "card 4111111111111111"), (6, "id 4111111111111111"), (7, "id 4111111111111112"),
    ]
    monkeypatch.setattr(pii, "table", lambda *a: docs(rows))
    got = {r.doc_id: r for r in pii.op9_pii(spark, "").collect()}
    assert [got[i].spans for i in range(1, 8)] == ["iban:7:34", "", "ssn:7:18", "", "card:5:21", "card:3:19", ""]
    assert got[5].top_score > got[6].top_score > got[7].top_score == 0
    plan = pii.op9_pii(spark, "")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange RoundRobin" in plan  # the fixture's own repartition only


def toxic_rows(n=600):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [draw.choice(words) for _ in range(60)]
        if toxic:
            for _ in range(3):
                text[draw.randrange(60)] = draw.choice(["idiot", "moron", "zzqux" + draw.choice("abcdefgh") * 2])
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = toxic_rows()
    table = spark.createDataFrame([*labels, (None, 1), (5, None), (10**9, 1)], "doc_id long, toxic int")
    df = docs([*rows, *[(i + 10**6, t) for i, t in ODD], (None, "x")])
    model = toxicity.train(df, table)
    got = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    assert any(w.startswith("zzq") for w in model.voters.words)
    held = [(got[i], i % 4 == 0) for i, _ in rows if got[i].held_out]
    assert len(held) > 100
    assert np.mean([r.predicted == t for r, t in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert not got[None].held_out and got[10**6 + 1].predicted == 0
    left = toxicity.drop_toxic(df, model)
    assert left.columns == df.columns and left.count() == sum(r.predicted == 0 for r in got.values())


def test_held_out_labels_teach_nothing(spark, docs):
    rows, labels = toxic_rows(200)
    df = docs(rows)
    kept = [x for x in labels if not brute_held(x[0])]
    flipped = [(i, t if not brute_held(i) else 1 - t) for i, t in labels]
    one, two = (toxicity.train(df, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (kept, flipped))
    assert one.voters.words == two.voters.words and np.allclose(one.weights, two.weights)


def brute_held(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs(), none)
    got = toxicity.scored(docs([(1, "you idiot moron"), (2, "fine day"), (3, None)]), model).collect()
    assert {r.doc_id: r.predicted for r in got} == {1: 1, 2: 0, 3: 0}
    assert toxicity.scored(docs([]), model).count() == 0


def test_many_spans_in_one_text_take_time_in_proportion(spark, docs, monkeypatch):
    text = "".join(f"user{n}@example{n % 7}.org, é 10.0.{n % 256}.{n % 200};\n" for n in range(50_000))
    monkeypatch.setattr(pii, "table", lambda *a: docs([(1, text), (2, "none")], 1))
    started = time.monotonic()
    got = {r.doc_id: r for r in pii.op9_pii(spark, "").collect()}
    assert (got[1].n_email, got[1].n_ip) == (50_000, 50_000)
    assert got[1].base_sha256 == brute.sha(brute.joined(brute.pii(text)))
    assert time.monotonic() - started < 60


def test_context_counts_on_both_sides(docs):
    rows = [(1, "ssn 123-45-6789"), (2, "123-45-6789 is the ssn"), (3, "123-45-6789" + " " * 60 + "ssn"), (4, "123-45-6789")]
    got = {r.doc_id: len(r.ssn) for r in pii.find(docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}
