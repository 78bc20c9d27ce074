import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.twins import SCHEMA, make, random_series, to_spark
from tidewell.operators import screen as S

K = ["station"]


def test_lof_finds_the_two_spikes(spark):
    rng = np.random.RandomState(0)
    v = rng.normal(size=100)
    v[30], v[70] = 9, -8
    ts = pd.date_range("2020-01-01", periods=100)
    d = make(spark, pd.DataFrame({"station": "x", "ts": ts, "value": v}), SCHEMA)
    hit = S.detect_lof(d, K, 5, 0.02, block=40).filter("anomaly").toPandas()
    assert sorted((hit.ts - ts[0]).dt.days) == [30, 70]


def brute_lof(x, k):
    n = len(x)
    near = [sorted((abs(x[i] - x[j]), j) for j in range(n) if j != i)[:k] for i in range(n)]
    kd = [m[-1][0] for m in near]
    lrd = [1 / (np.mean([max(d, kd[j]) for d, j in m]) + 1e-10) for m in near]
    return [np.mean([lrd[j] for _, j in m]) / lrd[i] for i, m in enumerate(near)]


def test_lof_scores_equal_brute_force(spark):
    rng = np.random.RandomState(3)
    v = rng.normal(size=150)
    ts = pd.date_range("2020-01-01", periods=150)
    d = make(spark, pd.DataFrame({"station": "x", "ts": ts, "value": v}), SCHEMA)
    got = S.lof_scores(d, K, 4, block=20).toPandas().sort_values("value").lof.to_numpy()
    want = np.array(brute_lof(v, 4))[np.argsort(v)]
    np.testing.assert_allclose(got, want, rtol=1e-6)


def test_lof_with_many_equal_values(spark):
    v = [1.0] * 60 + [1.5, 2.0, 50.0]
    ts = pd.date_range("2020-01-01", periods=len(v))
    d = make(spark, pd.DataFrame({"station": "x", "ts": ts, "value": v}), SCHEMA)
    hit = S.detect_lof(d, K, 5, 0.02).filter("anomaly").toPandas()
    assert 50.0 in set(hit.value) and 1.0 not in set(hit.value)


def test_median_test_against_pandas(spark):
    pdf = random_series(11, digits=2)
    got = S.median_test_twoside(to_spark(spark, pdf), K, level=0.7, filt_len=7, quantiles=(0.05, 0.95), seconds=11 * 3600).toPandas()
    want = []
    for _, s in pdf.groupby("station").value:
        res = s - s.rolling(7, center=True, min_periods=1).median()
        want += (res.abs() > 0.7 * (res.quantile(0.95) - res.quantile(0.05))).tolist()
    got = got.sort_values(["station", "ts"]).anomaly.tolist()
    assert got == want and sum(want) > 0


def test_immediate_step_hides_its_hits(spark):
    ts = pd.date_range("2020-01-01", periods=6)
    d = make(spark, pd.DataFrame({"station": "x", "ts": ts, "value": [1.0, 1.0, 99.0, 1.0, 2.0, 3.0]}), SCHEMA)
    steps = [{"method": "bounds_test", "args": {"bounds": [0, 10]}, "apply_immediately": True}, {"method": "repeat_test", "args": {"max_repeat": 1}}]
    rows = S.screen(d, K, steps).orderBy("ts").collect()
    assert [r.bounds_test for r in rows] == [False, False, True, False, False, False]
    assert [r.repeat_test for r in rows] == [True, True, False, False, False, False]
    assert [r.user_flag for r in rows] == [1, 1, 1, None, None, None]
    assert rows[2].value == 99.0


def test_protocol_cascade():
    base = [{"method": "bounds_test", "args": {"bounds": [0, 1]}}, {"method": "repeat_test"}, {"method": "median_test_oneside", "label": "fwd"}]
    cfg = {"defaults": {"global": {"steps": base}, "params": {"elev": {"inherits_global": True, "modify_steps": [{"method": "bounds_test", "args": {"bounds": [-10, 200]}}]}}},
           "regions": {"delta": {"params": {"elev": {"inherits_global": True, "omit_steps": ["fwd"], "modify_steps": "None"}}}},
           "stations": {"abc": {"params": {"elev": {"inherits_global": True, "add_steps": [{"method": "dip_test"}]}}, }, "xyz": {"params": {"elev": {"inherits_global": False, "steps": [{"method": "dip_test"}]}}}}}
    lab = lambda *a: [S.label_of(s) for s in S.resolve_protocol(cfg, *a)]
    assert lab("q", "flow") == ["bounds_test", "repeat_test", "fwd"]
    assert S.resolve_protocol(cfg, "q", "elev")[0]["args"]["bounds"] == [-10, 200]
    assert lab("q", "elev", "delta") == ["bounds_test", "repeat_test"]
    assert lab("abc", "elev", "delta") == ["bounds_test", "repeat_test", "dip_test"]
    assert lab("xyz", "elev", "delta") == ["dip_test"]
    with pytest.raises(ValueError):
        S.register_method("dip_test", lambda: None)


def test_inventory_equals_one_screen_per_series(spark):
    pdf = random_series(21, names=("a", "b", "c"), digits=1)
    d = to_spark(spark, pdf).withColumn("param", F.lit("p"))
    steps = [{"method": "bounds_test", "args": {"bounds": [-3, 3]}, "apply_immediately": True}, {"method": "repeat_test", "args": {"max_repeat": 1}},
             {"method": "short_run_test", "args": {"small_gap_len": 1, "min_run_len": 2}, "apply_immediately": True}, {"method": "dip_test", "args": {"low": 0.0, "dip": 1.0}}]
    cfg = {"defaults": {"global": {"steps": steps}}, "stations": {
        "b": {"params": {"p": {"inherits_global": True, "omit_steps": ["short_run_test"], "modify_steps": [{"method": "bounds_test", "args": {"bounds": [-1, 4]}}]}}},
        "c": {"params": {"p": {"inherits_global": False, "steps": [{"method": "bounds_test", "args": {"bounds": [0, 2]}}]}}}}}
    K2 = ["station", "param"]
    inventory = spark.createDataFrame([(x, "p", "default") for x in "abc"], "station string, param string, region string")
    got = S.auto_screen(d, cfg, inventory, seconds=13 * 3600).toPandas().sort_values(["station", "ts"])
    for x in "abc":
        one = S.screen(d.filter(F.col("station") == x), K2, S.resolve_protocol(cfg, x, "p"), labels=False).toPandas().sort_values("ts")
        a, b = got[got.station == x].user_flag.fillna(-1).tolist(), one.user_flag.fillna(-1).tolist()
        assert a == b and 1 in a
    shared, members = S.step_uses(cfg)
    assert len(shared) == 4 + 3 + 1 and len(members) == 4  # of the configuration, not of the inventory


def test_protocol_table_equals_each_cascade(spark):
    step = lambda m: {"method": "bounds_test", "label": m, "args": {"bounds": [0, 1]}}
    cfg = {"defaults": {"global": {"steps": [step("g")]}, "params": {"ec": {"inherits_global": True, "add_steps": [step("ec")]}}},
           "regions": {"delta": {"params": {"flow": {"inherits_global": True, "add_steps": [step("delta")]}}}},
           "stations": {"x": {"params": {"flow": {"inherits_global": True, "add_steps": [step("x")]}, "temp": {"inherits_global": False, "steps": [step("t")]}}}}}
    rows = [(s, p, r) for s in ("x", "y") for p in ("ec", "flow", "temp", "elev") for r in ("delta", "bay")]
    t = S.protocol_table(spark, cfg, spark.createDataFrame(rows, "station string, param string, region string")).collect()
    for at in rows:
        assert [r.label for r in sorted(t, key=lambda r: r.ord) if (r.station, r.param, r.region) == at] == [S.label_of(s) for s in S.resolve_protocol(cfg, *at)]
