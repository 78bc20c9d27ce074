import random
import zlib
from itertools import product

import numpy as np
import pytest

from tidewell.llm import best_fit as bf
from tidewell.llm.tokens import encode, vocabulary

BPE = vocabulary("byte_bpe_50k.json")


def used(plan):
    out = {}
    for pattern, times in plan:
        for x in pattern:
            out[x] = out.get(x, 0) + times
    return out


def fewest(items, capacity):
    """Least number of bins by trying every way."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: n for n, b in enumerate(bins)}.values():
            if bins[j] >= items[i]:
                place(i + 1, [*bins[:j], bins[j] - items[i], *bins[j + 1:]])
        place(i + 1, [*bins, capacity - items[i]])
    place(0, [])
    return best[0]


def counted(items):
    return {x: items.count(x) for x in set(items)}


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    items = [rng.randrange(1, 31) if seed % 2 else rng.randrange(8, 20) for _ in range(12)]
    plan = bf.bin_completion(counted(items), 30)
    assert used(plan) == counted(items)
    assert all(sum(p) <= 30 for p, _ in plan)
    assert sum(n for _, n in plan) == fewest(items, 30)


def test_completion_beats_best_fit_decreasing():
    items = counted([6, 6, 5, 5, 5, 3] * 3 + [7, 4, 4] * 2)
    bfd = sum(n for _, n in bf.best_fit_decreasing(items, 15))
    got = sum(n for _, n in bf.bin_completion(items, 15))
    assert got <= bfd and got == -(-sum(k * v for k, v in items.items()) // 15)


def test_large_counts_cost_no_more():
    rng = random.Random(0)
    items = {x: rng.randrange(1, 10**9) for x in range(1, 2049)}
    plan = bf.bin_completion(items, 2048, nodes=50)
    assert used(plan) == items and all(sum(p) <= 2048 for p, _ in plan)


def test_dominance_and_fillings():
    counts = {9: 1, 5: 2, 4: 1, 3: 1}
    assert bf.fillings(10, counts, [3, 4, 5, 9], 9)[0] == (5, 5)
    assert bf.dominated((4, 3), 10, [3, 4, 5, 9], counts)  # 9 stands for both
    for a, b in product((9, 5), repeat=2):
        assert sum(f for f in (a, b)) > 0


def packed(spark, texts, **more):
    d = spark.createDataFrame(texts, "doc_id long, text string")
    return bf.pack(d, tokenizer=BPE, end_id=0, capacity=16, **more).collect()


def test_pieces_and_places(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["tree", "sea", "of", "Wörter"]) for _ in range(rng.randrange(0, 60)))) for i in range(60)] + [(99, None), (None, "a b"), (7, "twice"), (7, "twice")]
    got = packed(spark, texts, with_ids=True)
    want = []
    for (i, _), x in zip(texts, encode(BPE, [t for _, t in texts]), strict=True):
        x = np.r_[x, 0].astype("<u4")
        at, piece = 0, 0
        while at < len(x):
            n = (len(x) % 16 or 16) if at == 0 else 16
            want.append((i or -1, piece, at, n, zlib.crc32(x[at:at + n].tobytes())))
            at, piece = at + n, piece + 1
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 16
    assert len(by) <= -(-sum(w[3] for w in want) // 16) + 1


def test_salted_ranks_and_sequences(spark, monkeypatch):
    monkeypatch.setattr(bf, "SALT_ROWS", 5)
    texts = [(i, "tree") for i in range(40)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    out = bf.pack(d, tokenizer=BPE, capacity=16, with_ids=True)
    seqs = bf.sequences(out).collect()
    n = out.first().length
    assert len(seqs) == -(-40 // (16 // n)) and sum(r.n_tokens for r in seqs) == 40 * n == sum(len(r.ids) for r in seqs) // 4


def test_empty(spark):
    assert packed(spark, []) == []
