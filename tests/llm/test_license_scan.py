import random

import duckdb
import pandas as pd

from tidewell.llm import license_scan as ls

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def both(spark, texts, **more):
    d = spark.createDataFrame(texts, "doc_id long, text string")
    got = ls.scan(d, **more).toPandas()
    con = duckdb.connect()
    documents = pd.DataFrame(texts, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "object"})
    con.register("documents", documents)
    want = con.execute(ls.scan_sql(**more)).df()
    key = lambda f: sorted(tuple(-1 if pd.isna(x) else round(x, 9) if isinstance(x, float) else x for x in r) for r in f[COLUMNS].itertuples(index=False))
    return key(got), key(want)


def test_scan_equals_all_blocks(spark):
    rng = random.Random(2)
    bits = [*ls.BASE, *ls.NOTICES, "the", "License", "MIT", "under", "cc", "by", "NC", "2", "apache", "é", "İx", "liKense", "word", ".", "-", "\n", "of this software"]
    texts = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    texts += [(100 + i, " ".join(w for w in p.split() if rng.random() < 0.85)) for i, p in enumerate([*ls.NOTICES] * 3)]
    got, want = both(spark, texts)
    assert got == want and sum(r[2] for r in got) > 20 and any(0 < r[7] < 1 for r in got)


def test_places_cross_blocks_and_count_once(spark):
    texts = [(i, "w " * i + "Released UNDER the MIT-license. " + "v " * 40) for i in range(70)] + [(99, "under the mit license " * 50), (98, "apache license version 2.0"), (97, "apache license version 20")]
    got, want = both(spark, texts)
    assert got == want
    rows = {r[0]: r for r in got}
    assert all(rows[i][2:5] == (1, i + 1, i + 1) for i in range(70))
    assert rows[99][2:5] == (50, 0, 196) and rows[98][2] == 1 and rows[97][2] == 0


def test_nulls_repeats_long_and_empty(spark):
    texts = [(1, None), (2, ""), (None, "cc by nc"), (3, "cc by nc"), (3, "cc by nc"), (4, "x " * 2_000 + "cc by nc")]
    got, want = both(spark, texts)
    assert got == want and [r[2] for r in got] == [1, 0, 0, 1, 1, 1]
    long = ls.scan(spark.createDataFrame([(1, "x " * 200_000 + "cc by nc")], "doc_id long, text string")).first()
    assert (long.n_words, long.first_word, long.labels) == (200_003, 200_000, "cc-by-nc")
    d = spark.createDataFrame([(1, "cc by nc", "x", 5)], "doc_id long, text string, labels string, p int")
    assert ls.scan(d).columns == COLUMNS and ls.scan(d).first().labels == "cc-by-nc"
    assert ls.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame([(1, "cc by nc")], "doc_id long, text string")
    plan = ls.scan(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
