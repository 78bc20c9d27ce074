import inspect
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewell.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def corpus(seed, n=200):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice(["b", "b", "b", "a", "é", None, "z", "tiny"] if i else ["tiny"])
        words = 3 if s == "tiny" else rng.randrange(0, 40) if rng.random() < 0.95 else 3000
        rows.append((i, rng.choice([" ", "\n", "\t "]).join("w" for _ in range(words)), s))
    return rows


def poured(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        unit = left / sum(w[s] for s in open_)
        for s in open_:
            out[s] += unit * w[s]
        left = sum(max(0.0, out[s] - cap * sizes[s]) for s in open_)
        full = {s for s in open_ if out[s] >= cap * sizes[s]}
        for s in full:
            out[s] = float(cap * sizes[s])
        open_ -= full
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_words(spark, seed):
    docs = corpus(seed)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    want = poured(sizes)
    got = mixing.words_taken(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()
    assert len(got) == len(docs)
    taken, of = Counter(), {i: s for i, _, s in docs}
    for r in got:
        assert r.target == pytest.approx(want[of[r.doc_id]], abs=1e-6) and r.source_size == sizes[of[r.doc_id]]
        assert 0 <= r.taken <= 2 * r.size
        taken[of[r.doc_id]] += r.taken
    assert all(0 <= want[s] - taken[s] < 1 + 1e-6 for s in sizes)  # whole words


def test_sql_gives_the_same_rows(spark):
    docs = [*corpus(5), (None, "a b", "b"), (None, "a b", "b"), (7, "a b c", None), (7, "a b c", None)]
    d = spark.createDataFrame(docs, SCHEMA)
    con = duckdb.connect()
    con.register("documents", d.toArrow())
    got = Counter(tuple(r) for r in mixing.words_taken(d).collect())
    assert got == Counter(con.execute(mixing.words_sql()).fetchall())


def test_places_are_the_points_of_the_sequence_ranked_by_source(spark):
    m = mixing.mix(spark.createDataFrame(corpus(6), SCHEMA), places=300)
    rows = sorted(m.places.collect(), key=lambda r: r.place)
    seen = Counter()
    for r in rows:  # ranks rise along the mix, one by one
        assert r.rank == seen[r.sid]
        seen[r.sid] += 1
    full = max(r.words for r in rows)
    last = {r.sid: r.rank for r in rows}
    assert len({r.place for r in rows}) == len(rows)
    assert all(r.words == full or r.rank == last[r.sid] for r in rows)
    # every stretch of the mix has each source's share, but for a few places
    for upto in (32, 64, 128, 256):
        part = Counter(r.sid for r in rows[:upto])
        assert all(abs(part[s] - upto * n / len(rows)) < 4 for s, n in seen.items())


def test_blocks_are_filled_by_the_words_of_their_source(spark):
    m = mixing.mix(spark.createDataFrame(corpus(7), SCHEMA), places=200)
    filled = {r.place: r.w for r in m.pieces.filter("words > 0").groupBy("place").agg(F.sum("words").alias("w")).collect()}
    assert filled == {r.place: r.words for r in m.places.collect()}
    spans = defaultdict(list)
    for r in m.pieces.filter("words > 0").collect():
        spans[r.sid, r.key, r.size, r.copy, r.turn].append((r.first_word, r.words))
    for s in spans.values():  # a document is taken in pieces without a gap
        s.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(s, s[1:]))


def test_rows_alone_decide(spark):
    docs = corpus(8)
    one = mixing.words_taken(spark.createDataFrame(docs, SCHEMA).coalesce(1)).collect()
    two = mixing.words_taken(spark.createDataFrame(docs[::-1], SCHEMA).repartition(9)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_copies_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "AT_ONCE", 16)
    docs = [(1, "a b c", "x")] * 300 + [(2, "d e", "y"), (3, None, "y"), (4, " \n", None), (5, "f " * 4000, "z")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], SCHEMA + ", place int, key string")
    got = mixing.words_taken(d).collect()
    assert len(got) == len(docs) and sum(r.taken for r in got if r.doc_id == 1) == 1800
    assert all(r.taken == 0 for r in got if r.doc_id in (3, 4))


def test_empty(spark):
    assert mixing.words_taken(spark.createDataFrame([], SCHEMA)).count() == 0
    only = mixing.words_taken(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in only} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_native(spark):
    source = inspect.getsource(mixing)
    assert not re.search(r"mapIn|applyIn|udf|\.rdd|toPandas", source)
