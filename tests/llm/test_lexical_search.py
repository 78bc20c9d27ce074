import math
import random
import re
from collections import Counter

from tidewell.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    out = []
    for q, t in items:
        rows = []
        asked = Counter(plain_terms(t))
        weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(w in b for _, b in bags) + 1))) for w in asked}
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // n_terms
            s = sum(c * weight[w] * ((10 ** 9 * b[w]) // (1000 * b[w] + 8 * m)) for w, c in asked.items() if b[w])
            if s > 0:
                rows.append((-s, (i is None, i), i))
        rows.sort(key=lambda r: r[:2])
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(rows[:k])]
    return Counter(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", "élan", "x1", "日本", *(f"w{rng.randrange(40)}" for _ in range(4))])
    texts = [rng.choice([" ", "-", ",\n", "_"]).join(word() for _ in range(rng.randrange(0, 30))) for _ in range(n)]
    docs = [(i, texts[i] if i % 3 else texts[0]) for i in range(n)]  # a third are copies of one text
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 12)))) for i in range(25)]
    return docs, items


def answer(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    b = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in ls.search(d, b, **kw).select("item_id", "rank", "doc_id", "score").collect())


def test_answers_are_those_of_all_scores(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        assert answer(spark, docs, items) == plain(docs, items)


def test_blocks_of_items_and_small_steps(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(ls, "CELLS", 40)
    assert answer(spark, docs, items, k=3, block_bytes=300) == plain(docs, items, 3)


def test_sums_beyond_doubles(spark, monkeypatch):
    board = ls._Board([(1, Counter({b"a": 3})), (2, Counter({b"b": 1}))], {b"a": 0, b"b": 1}, ls.np.array([7, 5]), ls.pa.int64(), ls.pa.int64())
    vectors = [ls.array("i", [0, 2, 1, 9]).tobytes(), ls.array("i", [1, 1]).tobytes()]
    m = ls.np.array([100, 40])
    fast = board.scores(m, vectors)
    board.exact = False
    assert (fast == board.scores(m, vectors)).all()
    assert fast[0, 0] == 3 * 7 * ((2 * 10 ** 9) // (2000 + 800))


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    docs = [(None, "red fox"), (3, "red fox"), (3, "red fox"), (4, None), (5, ""), (6, "--- !"), (7, "fox " * 60_000), (1, "blue")]
    items = [(1, "Red fox fox"), (1, "Red fox fox"), (2, None), (3, ""), (None, "blue"), (5, "absent"), (6, "fox"), (6, "blue red")]
    d = spark.createDataFrame([(a, t, 0, "x") for a, t in docs], "doc_id long, text string, h int, v string")
    b = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    got = Counter(tuple(r) for r in ls.search(d, b).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain(docs, sorted(set(items), key=str))


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for x, y in ((d, item), (one, b), (d, b)):
        assert ls.search(x, y).columns == ["item_id", "rank", "doc_id", "score"]
        assert ls.search(x, y).count() == 0
    assert ls.search(one, item).count() == 1


def test_string_keys(spark):
    d = spark.createDataFrame([("b", "a"), ("a", "a"), ("c", "z")], "doc_id string, text string")
    item = spark.createDataFrame([("q", "a")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in ls.search(d, item).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
