import random

import pytest

from tidewell.llm import toxicity as tx

LEX = tx.Lexicon({"idiot": 5.0, "mor*": 4.0}, frozenset({"idiot board"}), ((0.0, 0.01), (1.0, 0.9)), 0.25)


def test_fold_undoes_substitutions():
    assert tx.fold("1D10T").split() == ["idiot"]
    assert tx.fold("idіоt ｍoron").split() == ["idiot", "moron"]  # Cyrillic letters, a full-width one
    assert tx.fold("id​iot!").split() == ["idiot"]
    assert tx.fold("p@thetic cla$h $5").split()[:2] == ["pathetic", "clash"]
    assert tx.fold(None) == ""


@pytest.mark.parametrize("text,n", [("an idiot", 1), ("idiots", 0), ("an idiot board", 0), ("moron, morons and more", 3), ("", 0), (None, 0), ("humorous", 0), ("IDIOT\nIDIOT", 2)])
def test_terms_stems_and_exceptions(text, n):
    assert len(tx.spans(text, LEX)) == n


def test_matches_are_those_of_plain_search():
    rng = random.Random(3)
    parts = ["idiot", "idiots", "mor", "moron", "amoron", "board", "x", "idiot board", "1diot"]
    m = tx.Matcher(LEX)
    for _ in range(300):
        folded = tx.fold(" ".join(rng.choice(parts) for _ in range(12)))
        words = folded.split(" ")
        want = 0
        for i, w in enumerate(words):
            excepted = w == "idiot" and words[i + 1:i + 2] == ["board"]
            want += (w == "idiot" and not excepted) or w.startswith("mor")
        assert len(m.matches(folded)) == want


def rows(n=400):
    rng = random.Random(1)
    plain = ["tree", "river", "stone", "cloud", "green", "walk", "over", "under", "light", "winter"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpf", "zortling", "zortler"]))
        docs.append((i, " ".join(words), f"x{i}"))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_columns(spark):
    docs, labels = rows()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lb = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = tx.learn(d, lb)
    assert "grumpf" in lexicon.terms and any(t.startswith("zort") for t in lexicon.terms)
    got = {r.doc_id: r for r in tx.score(d, lexicon).collect()}
    assert len(got) == len(docs)
    assert sum(got[i].predicted == y for i, y in labels if got[i].held_out) == sum(got[i].held_out for i, _ in labels)
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = tx.drop_toxic(d, lb)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, y in labels if not y}


def test_nulls_repeats_empty_and_long(spark):
    lexicon = tx.Lexicon({"idiot": 5.0}, frozenset(), ((0.0, 0.0), (0.1, 0.8)))
    d = spark.createDataFrame([(1, None), (None, "idiot"), (2, ""), (2, ""), (3, "idiot " * 200_000)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.predicted, r.held_out is None) for r in tx.score(d, lexicon).collect())
    assert got == [(-1, 1, False), (1, 0, False), (2, 0, False), (2, 0, False), (3, 1, False)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    no = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.score(empty, lexicon).count() == 0
    assert tx.learn(d, no).terms == {} and tx.learn(empty, no).terms == {}
    assert tx.drop_toxic(d, no).count() == 5


def test_more_tasks_than_rows(spark):
    docs = spark.createDataFrame([(i, "grumlak vile" if i % 2 else "calm words") for i in range(40)], "doc_id long, text string").repartition(60)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int").repartition(60)
    rows = tx.score(docs, tx.learn(docs, labels)).collect()
    assert len(rows) == 40 and all(0 <= r.score <= 1 for r in rows)
    assert tx.drop_toxic(docs, labels).count() <= 40
    one = labels.limit(1)  # no row of one of the classes
    assert tx.score(docs, tx.learn(docs, one)).count() == 40
