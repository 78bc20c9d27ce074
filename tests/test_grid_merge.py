import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import twins
from tests.twins import make, random_series, to_spark
from tidewell.operators import grid as G, merge as M

K = ["station"]
SEC = 5 * 3600


def frames(seed, n=3):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        a = int(rng.integers(0, 60))
        hours = [a + i for i in range(int(rng.integers(5, 60))) if rng.random() > 0.2]
        out.append([(h, None if rng.random() < 0.3 else float(np.round(rng.normal(), 3))) for h in hours])
    return out


def as_spark(spark, f):
    rows = [("s", pd.Timestamp("2024-01-01") + pd.Timedelta(hours=h), v) for h, v in f]
    return make(spark, rows, twins.SCHEMA)


def hours(df):
    return {int((r.ts - pd.Timestamp("2024-01-01").to_pydatetime()).total_seconds() // 3600): r.value for r in df.orderBy("ts").collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_and_splice(spark, seed):
    fs = frames(seed)
    ds = [as_spark(spark, f) for f in fs]
    assert hours(M.ts_merge(ds, K)) == twins.merge(fs)
    assert hours(M.ts_merge(ds, K, strict_priority=True)) == twins.merge(fs, True)
    assert hours(M.ts_splice(ds, K, "first", seconds=SEC)) == twins.splice(fs, "first")
    assert hours(M.ts_splice(ds, K, "last", seconds=SEC)) == twins.splice(fs, "last")


def test_merge_identity_and_empty_source(spark):
    f = frames(7)[0]
    d = as_spark(spark, f)
    none = d.withColumn("value", F.lit(None).cast("double"))
    assert hours(M.ts_merge([d, d], K)) == dict(f)
    assert hours(M.ts_splice([none, d], K, "first")) == dict(f)
    assert hours(M.ts_splice([d, none], K, "last")) == dict(f)


def test_overlapping_shards_are_an_error(spark):
    t = pd.Timestamp("2024-01-01")
    rows = [("s", sh, t + pd.Timedelta(minutes=15 * i), 1.0) for sh, off in (("a", 0), ("b", 3)) for i in range(off, off + 5)]
    d = make(spark, rows, "station string, shard string, ts timestamp_ntz, value double")
    with pytest.raises(ValueError, match="overlap"):
        M.merge_shards(d, K)
    assert M.merge_shards(d.filter("shard = 'a'"), K).count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_regularize(spark, seed):
    rng = np.random.default_rng(seed)
    us = np.unique(rng.integers(0, 200, 60)) * 450_000_000 // 2
    rows = [(int(u), None if rng.random() < 0.3 else float(i)) for i, u in enumerate(us)]
    d = make(spark, [("s", pd.Timestamp(u, unit="us"), v) for u, v in rows], twins.SCHEMA)
    got = {int(pd.Timestamp(r.ts).value // 900_000_000_000): r.value for r in G.regularize(d, K, 900).collect()}
    assert got == twins.regularize(rows, 900_000_000)


def test_coarsen_over_chunks(spark):
    rng = np.random.default_rng(4)
    v = np.round(np.cumsum(rng.normal(0, 1, 300)), 2)
    v[40:60] = 0.0
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(300), unit="h")
    d = make(spark, pd.DataFrame({"station": "s", "ts": ts, "value": v}), twins.SCHEMA)
    want = twins.coarsen(list(enumerate(v.tolist())), 0.5, 2.0, 24, (0.0,))
    got = G.coarsen(d, K, 3600, 0.5, 2.0, 24 * 3600, (0.0,), seconds=9 * 3600)
    assert list(hours(got).items()) == [(t, pytest.approx(x)) for t, x in want]


def test_disaggregation_keeps_means_and_bound(spark):
    rng = np.random.default_rng(9)
    v = np.abs(rng.normal(0, 5, 40)).round(2)
    v[5] = 0.0
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(40), unit="D")
    d = make(spark, pd.DataFrame({"station": "s", "ts": ts, "value": v}), twins.SCHEMA)
    f = G.disaggregate(d, K, 86400, 900, lowbound=0.0, seconds=4 * 86400).toPandas()
    assert len(f) == 40 * 96 and f.value.min() > -1e-9
    np.testing.assert_allclose(f.groupby(f.ts.dt.floor("D")).value.mean().to_numpy(), v, atol=1e-9)


def test_blend_is_exact_at_edges_and_keeps_primary(spark):
    h = list(range(40))
    p = [(i, None if 10 <= i < 30 else 5.0) for i in h]
    s = [(i, 1.0 if i < 20 else 2.0) for i in h]
    got = hours(M.ts_blend(as_spark(spark, p), as_spark(spark, s), K, 4 * 3600, seconds=SEC))
    assert all(got[i] == 5.0 for i in range(10))
    assert got[20] == pytest.approx(2.0) and 1.0 < got[11] < 5.0 and got[13] == pytest.approx(1.0)


def test_frequencies(spark):
    t = pd.Timestamp("2024-01-01")
    rows = [("reg", t + pd.Timedelta(minutes=15 * i), 1.0) for i in range(16)] + [("irr", t + pd.Timedelta(minutes=m), 1.0) for m in (0, 10, 15)]
    f = {r.station: r.freq for r in G.infer_freq(make(spark, rows, twins.SCHEMA), K).collect()}
    assert f == {"reg": 900, "irr": None}
    assert G.target_freq([(0, 3600), (1, 900)], "as_freq_finer") == 900
    assert G.target_freq([(0, 3600), (1, 900)], "interp_to_coarser") == 3600
    with pytest.raises(ValueError):
        G.target_freq([(0, 3600), (1, 900)], None)
    assert G.ingest_policy(3600, 900) == ("interp", "finer")
    with pytest.raises(ValueError):
        G.ingest_policy(900, 3600)


def test_daylight_hour_in_order(spark):
    rows = [("s", "2024-11-03 00:30", 1), ("s", "2024-11-03 01:30", 2), ("s", "2024-11-03 01:10", 3), ("s", "2024-11-03 02:30", 4), ("s", "2024-03-10 02:30", 0)]
    d = make(spark, [(a, pd.Timestamp(b), float(c), c) for a, b, c in rows], "station string, ts timestamp_ntz, value double, seq long")
    got = {int(r.value): str(r.ts) for r in G.local_to_fixed(d, K).collect()}
    assert got == {0: "2024-03-10 02:30:00", 1: "2024-11-02 23:30:00", 2: "2024-11-03 00:30:00", 3: "2024-11-03 01:10:00", 4: "2024-11-03 02:30:00"}


def test_grid_guard(spark):
    d = make(spark, [("s", pd.Timestamp("1900-01-01"), 1.0), ("s", pd.Timestamp("2024-01-01"), 1.0)], twins.SCHEMA)
    other = make(spark, [("t", pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=m), 1.0) for m in range(3)], twins.SCHEMA)
    found = G.sparse_series(d.unionByName(other), K, 60, 100_000).collect()
    assert [(r.station, r.reason) for r in found] == [("s", "sparse_grid")]
    # the operator itself has no limit: the sparse series is gridded, the others too
    n = {r.station: r.n for r in G.regularize(d.unionByName(other), K, 3600 * 24).groupBy("station").agg(F.count("*").alias("n")).collect()}
    assert n == {"s": 45_291, "t": 1}


def test_splice_of_many_parts(spark):
    from tidewell.operators.merge import splice_named, ts_splice
    rows = [("s", "p", f"f{i % 600:03d}", (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i % 600 + 7 * j)).to_pydatetime(), float(i) if (i + j) % 9 else None) for i in range(600) for j in range(4)]
    d = spark.createDataFrame(rows, "station string, param string, file string, ts timestamp_ntz, value double")
    for how in ("first", "last"):
        got = {(r.file, r.ts, r.value) for r in splice_named(d, ["station", "param"], "file", how).collect()}
        few = d.filter("file < 'f004'")
        parts = [few.filter(f"file = 'f00{i}'").drop("file") for i in range(4)]
        want = sorted((r.ts, r.value) for r in ts_splice(parts, ["station", "param"], how).filter("value IS NOT NULL").collect())
        assert want == sorted((r.ts, r.value) for r in splice_named(few, ["station", "param"], "file", how).filter("value IS NOT NULL").collect())
        span = {}
        for _, _, f, t, v in rows:
            if v is not None:
                a, b = span.get(f, (t, t))
                span[f] = (min(a, t), max(b, t))
        names = sorted(span)
        expect = set()
        for _, _, f, t, v in rows:
            k = names.index(f)
            if how == "last":
                later = [span[x][0] for x in names[k + 1:]]
                ok = (k == 0 or t >= min([span[f][0], *later])) and (not later or t < min(later))
            else:
                earlier = [span[x][1] for x in names[:k]]
                ok = (k == len(names) - 1 or t <= max([span[f][1], *earlier])) and (not earlier or t > max(earlier))
            if ok:
                expect.add((f, t, v))
        assert got == expect
