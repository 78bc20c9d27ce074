import os
import random

import corpus_pipeline as cp
import pytest

from tests.llm import brute
from tidewell.llm import toxicity
from tidewell.session import scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(90))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(90)
    docs, labels = [], []
    for i in range(160):
        t = text(60)
        if i % 5 == 0:
            for _ in range(4):
                t = t.replace(" ", " grumpf ", 1) if rng.random() < 0.5 else f"{t} zortling"
        elif i % 5 == 4:
            w = docs[-1][1].split(" ")
            w[3] = word()
            t = " ".join(w)
        elif i % 5 == 2:
            t = f"{text(30)} {passage} {text(30)}"
        docs.append((i, t, "en", "s", len(t)))
        labels.append((i, 1, int("grumpf" in t or "zortling" in t)))
    path = scratch(spark, "corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs, dict((i, y) for i, _, y in labels)


def test_each_stage_on_its_input(spark, folder):
    path, docs, toxic = folder
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near duplicates", "repeated passages", "packing"]
    df = spark.read.parquet(f"{path}/documents.parquet")
    one = cp.toxic(spark, df, path)
    assert one.columns == df.columns
    kept = {r.doc_id: r.text for r in one.collect()}
    assert set(kept) == {i for i in toxic if not toxic[i]}
    two = cp.near_duplicates(spark, one, path)
    groups = brute.jaccard_groups(list(kept.items()))
    left = {r.doc_id: r.text for r in two.collect()}
    assert set(left) == {i for i in kept if groups[i][1] == i} and len(left) < len(kept)
    three = cp.repeated_passages(spark, two, path)
    assert three.columns == df.columns
    want = brute.first_kept(list(left.items()), cp.PASSAGE_BYTES)
    assert {r.doc_id: r.text.encode() for r in three.collect()} == want
    assert sum(map(len, want.values())) < sum(len(t.encode()) for t in left.values())
    four = cp.packed(spark, three, path).collect()
    assert {r.doc_id for r in four} == set(left)
    assert sorted(map(tuple, cp.run(spark, path).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in four)


def test_passages_are_judged_by_words(spark):
    rng = random.Random(3)
    text = lambda n, size: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(*size))) for _ in range(n))
    short, fifty, one, two = text(51, (2, 3)), text(50, (7, 9)), text(30, (5, 6)), text(30, (5, 6))
    assert len(short) < 256 < len(fifty)
    docs = [(i, f"{text(8, (2, 5))} {short}\n {text(8, (2, 5))} {fifty} {text(9, (3, 4))}") for i in range(6)]
    docs += [(10, f"{one} {text(9, (3, 4))}"), (11, f"{two} {text(9, (3, 4))}"), (12, f"{one} {two}"), (13, "a " * 120), (14, f"x{short} tail"), (15, short), (16, f"{short}z {short}")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in cp.repeated_passages(spark, d, SF).collect()}
    assert {i: t.encode() for i, t in got.items()} == brute.passages_kept(docs, 50)
    assert short in got[0] and not any(short in got[i] for i in range(1, 6)) and got[15] == ""
    assert all(fifty in got[i] for i in range(6)) and got[12] == f"{one} {two}"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_given_tables(spark):
    out = cp.run(spark, SF)
    assert out.count() > 0
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert len(got) == docs.count()
