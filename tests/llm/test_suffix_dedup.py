import random
import time

import numpy as np
import pytest

from tests.llm import brute
from tidewell.llm import suffix_dedup as sd


def corpus(seed, n=40):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdeé ") for _ in range(k))
    shared = [text(k) for k in (70, 64, 90, 200)]
    out = []
    for i in range(n):
        t = text(rng.randrange(0, 150))
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(0, 20)
            t += s[a:] + text(rng.randrange(0, 60))
        if i % 9 == 0:
            t = "ab" * 80 + t  # periodic
        if i % 7 == 0 and out:
            t = out[rng.randrange(len(out))]
        out.append(t)
    return out


def check(spark, texts, length):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.removal_digest(d, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == brute.repeated(texts, length)
    first = {r.doc_id: bytes(r.kept) for r in sd.remove_copies(d, length=length, keep="first").collect()}
    assert first == brute.first_kept(list(enumerate(texts)), length)


def test_removed_bytes_are_those_of_all_windows(spark):
    for seed, length in ((1, 64), (2, 40), (3, 51)):
        check(spark, corpus(seed), length)


def test_anchor_with_many_contexts_is_decided_by_windows(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", 3)
    check(spark, corpus(5), 64)


def test_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 700)
    monkeypatch.setattr(sd, "PIECE", 100)
    monkeypatch.setattr(sd, "SLAB", 300)
    check(spark, corpus(6), 64)


def test_factors_are_longest_earlier_and_later_matches():
    rng = random.Random(4)
    bodies = ["".join(rng.choice("ab") for _ in range(rng.randrange(40, 60))).encode() for _ in range(8)]
    length = 32
    windows = np.array([len(b) - length + 1 for b in bodies])
    body, place, lpf, llf = sd.suffix_factors(bodies, windows, np.arange(len(bodies)), length)
    starts = [(int(b), int(p)) for b, p in zip(body, place, strict=True)]

    def common(x, y):
        a, b = bodies[x[0]][x[1]:x[1] + length], bodies[y[0]][y[1]:y[1] + length]
        return next((i for i, (c, d) in enumerate(zip(a, b, strict=True)) if c != d), length)
    for i, s in enumerate(starts):
        assert lpf[i] == max((common(s, t) for t in starts if t < s), default=0)
        assert llf[i] == max((common(s, t) for t in starts if t > s), default=0)


def test_cuts_keep_whole_characters():
    t = "aéb".encode()
    assert sd.keep_text(t, [(2, 3)]) == "aéb"
    assert sd.keep_text(t, [(1, 3)]) == "ab"


def test_passages_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 3000)
    rng = random.Random(1)
    docs = [(i, "".join(rng.choice(["a", "b", "ab"]) * rng.choice([1, 1, 2]) + rng.choice([" ", " ", " ", "  ", "\n", ""]) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    got = {r.doc_id: r.text.encode() for r in sd.without_passages(spark.createDataFrame(docs, "doc_id long, text string"), words=3).collect()}
    assert got == brute.passages_kept(docs, 3)


def test_nulls_repeats_extra_columns_and_empty(spark):
    x = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    d = spark.createDataFrame([(1, None, "p"), (2, "", "q"), (None, x, "r"), (4, "zz" + x, "s"), (4, "zz" + x, "s"), (5, "short", None)], "doc_id long, text string, kept string")
    got = sorted((r.doc_id or -1, r.n_bytes - r.n_removed) for r in sd.remove_copies(d, length=40).collect())
    assert got == [(-1, 0), (1, 0), (2, 0), (4, 0), (4, 0), (5, 5)]
    out = sd.without_copies(d, length=40)
    assert out.columns == d.columns
    assert sorted((r.doc_id or -1, r.text, r.kept or "") for r in out.collect() if r.doc_id != 1) == [(-1, x, "r"), (2, "", "q"), (4, "zz", "s"), (4, "zz", "s"), (5, "short", "")]
    assert [r.text for r in out.collect() if r.doc_id == 1] == [None]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sd.removal_digest(empty).collect() == []
    with pytest.raises(ValueError):
        sd.remove_copies(d, length=5)


def test_passages_are_decided_in_suffix_order(spark, monkeypatch):
    rng = random.Random(7)
    docs = [(i, "".join(rng.choice(["a", "b", "ab"]) * rng.choice([1, 1, 2]) + rng.choice([" ", " ", "  ", "\n"]) for _ in range(rng.randint(0, 50)))) for i in range(100)]
    want = brute.passages_kept(docs, 4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = lambda: {r.doc_id: r.text.encode() for r in sd.without_passages(d, words=4).collect()}

    def hashed(*_):
        raise AssertionError("decided by hashes")
    with monkeypatch.context() as m:
        m.setattr(sd, "_word_windows", hashed)
        assert got() == want
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", 4)
    assert got() == want


def shuffled(spark):
    """MB shuffled so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    time.sleep(0.5)
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite() / 1e6


def test_anchor_with_many_contexts_takes_no_second_exchange_of_texts(spark, monkeypatch):
    rng = random.Random(11)
    text = lambda k: "".join(chr(rng.randrange(33, 127)) for _ in range(k))
    passage = text(90)
    texts = [text(6000) + passage + text(6000) for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)

    def run():
        before = shuffled(spark)
        got = sorted(tuple(r) for r in sd.removal_digest(d, length=64).drop("text").collect())
        return got, shuffled(spark) - before
    few, base = run()
    assert min(r[2] for r in few) >= 90
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", 3)
    many, mb = run()
    assert many == few
    assert mb < base + 0.3 * sum(map(len, texts)) / 1e6


def test_passages_with_many_contexts_take_no_further_exchange_of_texts(spark, monkeypatch):
    rng = random.Random(12)
    text = lambda k: " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(12)) for _ in range(k))
    passage = text(8)
    texts = [f"{text(500)} {passage} {text(500)}" for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)

    def run():
        before = shuffled(spark)
        got = sorted(tuple(r) for r in sd.without_passages(d, words=5).collect())
        return got, shuffled(spark) - before
    few, base = run()
    assert sum(len(r[1]) < len(texts[r[0]]) for r in few) == 59
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", 3)
    many, mb = run()
    assert many == few
    # the neighbours that differ are shuffled too
    assert mb < base + 1.5 * sum(map(len, texts)) / 1e6
