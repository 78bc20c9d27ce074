import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import groups
from tidewell.llm import ann_forest as ann, rp_forest as rp

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def vectors(seed, n=600, size=16, centres=12, noise=0.25):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, size))
    x = c[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, size))
    return x.astype(np.float32)


def nearest(ids, x, queries, k):
    x = x.astype(np.float64)
    out = {}
    for i in queries:
        s = np.array([math.fsum(a * b for a, b in zip(x[i], r, strict=True)) for r in x])
        order = sorted((j for j in range(len(ids)) if ids[j] != ids[i]), key=lambda j: (-s[j], ids[j]))
        out[ids[i]] = [(ids[j], s[j]) for j in order[:k]]
    return out


def test_recall_and_order(spark):
    x = vectors(1)
    d = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = {}
    for r in ann.nearest(d, query=F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = nearest(range(len(x)), x, range(0, len(x), 20), 10)
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, rows in got.items():
        assert [r for r, *_ in rows] == list(range(1, 11))
        assert all(s == pytest.approx(float(x[q].astype(float) @ x[v].astype(float)), abs=1e-9) for _, v, s in rows)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)


def test_unstructured_vectors_of_any_norm(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(400, 24)) * rng.uniform(0.2, 3, size=(400, 1))).astype(np.float32)
    d = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = {}
    for r in ann.nearest(d, query=F.col("vec_id") % 10 == 0, k=5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = nearest(range(len(x)), x, range(0, 400, 10), 5)
    assert sum(len(got[q] & {v for v, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_queries_off_the_clusters_reach_their_candidates(spark, monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(4, 16))[rng.integers(0, 4, 800)] * 3 + 0.05 * rng.normal(size=(800, 16))
    x = np.r_[dense, 3 * rng.normal(size=(200, 16))].astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "_fit", lambda *a: (4000, 10))  # the clusters' depth; others have so many only under shorter prefixes
    got = {}
    for r in ann.nearest(frame(spark, rows), query=F.col("vec_id") % 8 == 0, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asks = range(800, 1000, 8)
    want = nearest(range(len(x)), x, asks, 20)
    assert sum(len(got[q] & {v for v, _ in want[q]}) for q in asks) >= 0.95 * 20 * len(asks)


def test_equal_vectors_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK_ROWS", 7)
    one, two = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(i, one, 0) for i in range(50)] + [(100, two, 0), (101, None, 0), (102, [0.0, 0.0, 0.0], 0), (103, [1.0, None, 1.0], 0), (104, [NAN, 1.0, 0.0], 0), (105, [INF, 1.0, 0.0], 0), (None, one, 0), (100, two, 0)]
    got = {}
    for r in ann.nearest(frame(spark, rows), k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {*range(50), 100}
    for q in range(50):
        assert got[q] == [v for v in range(50) if v != q][:20]
    assert got[100] == list(range(20))
    few = frame(spark, [(1, one, 0), (2, two, 0)])
    assert sorted((r.query_id, r.vec_id) for r in ann.nearest(few, k=20).collect()) == [(1, 2), (2, 1)]
    assert ann.nearest(frame(spark, []), k=3).collect() == []


def links(rows, cosine):
    unit = {}
    for i, v, label in rows:
        if v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            a = np.array(v, np.float64)
            unit[i] = (a / np.linalg.norm(a), label)
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a][1] == unit[b][1] and float(unit[a][0] @ unit[b][0]) >= cosine]
    comp = groups(pairs, [r[0] for r in rows])
    return {i: (sum(i in p for p in pairs), comp[i], comp[i] == i) for i, *_ in rows}


def near(spark, rows, **more):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rp.near_vectors(frame(spark, rows), **more).collect()}


def clustered(seed, n=400):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 64))
    out = []
    for i in range(n):
        v = base[rng.integers(40)] + rng.choice([0.0, 0.1, 0.14, 0.3]) * rng.normal(size=64)
        out.append((i, (v * rng.uniform(0.5, 2)).astype(np.float32).tolist(), int(rng.integers(3)) if i % 11 else None))
    return out


def test_links_are_those_of_all_pairs(spark, monkeypatch):
    rows = clustered(1)
    assert near(spark, rows) == links(rows, 0.98)
    monkeypatch.setattr(rp, "LEAF_ROWS", 10)  # deep trees
    monkeypatch.setattr(rp, "CELL_ROWS", 4)  # leaves in cells
    assert near(spark, rows) == links(rows, 0.98)


def test_odd_vectors_and_repeats(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(5, a, 1), (3, a, 1), (4, [2.0, 4.0, 6.0], 1), (6, a, 2), (7, a, None), (8, None, 1), (9, [0.0] * 3, 1), (10, [1.0, None, 3.0], 1), (11, [NAN, 2.0, 3.0], 1), (12, [INF, 2.0, 3.0], 1), (13, b, 1)]
    assert near(spark, rows) == links(rows, 0.98)
    d = frame(spark, [*rows, (None, a, 1), (3, a, 1)]).withColumn("n_links", F.lit("x"))
    got = rp.near_vectors(d)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((r.vec_id or -1, r.n_links) for r in got.collect())[:4] == [(-1, 0), (3, 2), (3, 2), (4, 2)]
    assert rp.near_vectors(frame(spark, [])).collect() == []


def test_vectors_of_another_length_and_repeated_ids(spark):
    rows = [(i, "a", [1.0, float(i % 4), 0.5]) for i in range(12)] + [(50, "a", [1.0, 2.0]), (51, "a", [1.0, 2.0]), (3, "a", [9.0, 9.0, 9.0]), (None, "a", [1.0, 0.0, 0.5])]
    d = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").repartition(5)
    first = sorted(map(tuple, ann.nearest(d, k=3).collect()))
    assert first == sorted(map(tuple, ann.nearest(d.repartition(2), k=3).collect()))
    assert {r[0] for r in first} == set(range(12))
    near = {r.vec_id: (r.n_links, r.component_id) for r in rp.near_vectors(d).collect() if r.vec_id in (50, 51)}
    assert near == {50: (0, 50), 51: (0, 51)}
