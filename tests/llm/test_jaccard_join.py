import random

from tests.llm import brute
from tidewell.llm import jaccard_join as jj


def corpus(seed, n=120):
    """Bases, copies with edits of all strengths, shared passages, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    passage = [word() for _ in range(40)]
    docs = []
    for i in range(n):
        kind = i % 6
        if kind < 3 and docs:
            w = docs[rng.randrange(len(docs))].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = word()
            docs.append(" ".join(w))
        elif kind == 3:
            docs.append(" ".join(passage + [word() for _ in range(rng.choice([2, 5, 9, 12, 40]))]))
        elif kind == 4:
            docs.append(" ".join(word() for _ in range(rng.randrange(0, 7))))
        else:
            docs.append(" ".join(word() for _ in range(rng.randrange(20, 90))))
    return docs


def check(spark, docs, percent=80):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.similar_groups(d, percent=percent).collect()}
    assert got == brute.jaccard_groups(docs, percent)


def test_groups_are_those_of_all_pairs(spark):
    for seed in (1, 2):
        check(spark, list(enumerate(corpus(seed))))
    check(spark, list(enumerate(corpus(3))), percent=60)


def test_long_lists_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(jj, "CELL_ROWS", 3)
    monkeypatch.setattr(jj, "PAIRS_AT_ONCE", 5)
    check(spark, list(enumerate(corpus(4, 90))), percent=70)


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(jj, "BUCKET_SHINGLES", 200)
    check(spark, list(enumerate(corpus(5, 90))))


def test_words_case_and_white_space(spark):
    docs = [(1, "A b\tC d\x0be f"), (2, "a B  c D e F"), (3, "É b c d e f"), (4, "é b c d e f"), (5, "a b c d e f"), (6, "x y"), (7, "X\ny"), (8, "x x y")]
    check(spark, docs)


def test_nulls_repeats_extra_columns_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    d = spark.createDataFrame([(4, None, 1), (5, "", 2), (None, "a b c d e f", 3), (7, "a b c d e f", 4), (7, "a b c d e f", 5), (6, "a b c d e f", 6), (9, long, 7), (8, long + " z", 8)],
                              "doc_id long, text string, n_shingles int")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jj.similar_groups(d).collect())
    assert got == [(-1, 2, None), (4, 0, 4), (5, 0, 5), (6, 2, 6), (7, 2, 6), (7, 2, 6), (8, 29_997, 8), (9, 29_996, 8)]
    left = jj.drop_similar(d)
    assert left.columns == d.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 4, 5, 6, 8]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jj.similar_groups(empty).collect() == []
