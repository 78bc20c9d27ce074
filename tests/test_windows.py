import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.twins import interpolate, make, random_series, run_lengths, same, to_spark
from tidewell.operators import windows as W
from tidewell.operators.aggs import exact_quantiles

K = ["station"]


@pytest.mark.parametrize("seconds", [7 * 3600, 30 * 86400])
def test_fills_and_runs_over_chunk_edges(spark, seconds):
    pdf = random_series(1)
    d = to_spark(spark, pdf).cache()
    g = pdf.groupby("station").value
    w = pdf.copy()
    for limit in (3, None):
        w["filled"] = g.transform(lambda s: interpolate(s, limit))
        same(W.interpolate(d, K, limit, seconds=seconds), w, "filled")
    w["filled"] = g.transform(lambda s: s.ffill(limit=2).bfill(limit=2))
    same(W.fill_sweep(d, K, 2, seconds=seconds), w, "filled")
    w["shifted"] = g.transform(lambda s: s.shift(-4))
    same(W.shift(d, K, -4, seconds=seconds), w, "shifted")
    w["run_len"] = g.transform(lambda s: run_lengths(s, lambda x: x.fillna(-99)).where(s.notna()))
    same(W.run_length(d, K, seconds=seconds), w, "run_len")
    w["gap_len"] = g.transform(lambda s: run_lengths(s, lambda x: x.isna()).where(s.isna(), 0))
    same(W.gap_length(d, K, seconds=seconds), w, "gap_len")
    w["median"] = g.transform(lambda s: s.rolling(7, center=True, min_periods=1).median())
    same(W.rolling_median(d, K, 7, seconds=seconds, block=20), w, "median")


def test_result_does_not_depend_on_placement(spark):
    d = to_spark(spark, random_series(5))
    a = W.interpolate(d.repartition(1), K, 5, seconds=5 * 3600).toPandas()
    b = W.interpolate(d.repartition(7).sort(F.desc("value")), K, 5).toPandas()
    by = ["station", "ts"]
    pd.testing.assert_frame_equal(a.sort_values(by).reset_index(drop=True), b.sort_values(by).reset_index(drop=True))


def test_one_exchange_moves_the_rows(spark):
    """Both branches of a scan read one placement of the rows."""
    d = to_spark(spark, random_series(2))
    out = W.interpolate(d.groupBy("station", "ts").agg(F.max("value").alias("value")), K, 3)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 1


def test_filters(spark):
    n = 200
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="h")
    const = pd.DataFrame({"station": "c", "ts": ts, "value": 4.0})
    slow = pd.DataFrame({"station": "slow", "ts": ts, "value": np.sin(2 * np.pi * np.arange(n) / 100)})
    fast = pd.DataFrame({"station": "fast", "ts": ts, "value": np.sin(2 * np.pi * np.arange(n) / 4)})
    hole = const.assign(station="hole")
    hole.loc[100, "value"] = np.nan
    f = W.lowpass(to_spark(spark, pd.concat([const, slow, fast, hole])), K, 3600, 12 * 3600, block=60).toPandas()
    k = 18
    for name in ("c", "slow", "fast", "hole"):
        x = f[f.station == name].sort_values("ts").reset_index(drop=True)
        assert x.filtered[:k].isna().all() and x.filtered[n - k:].isna().all()
        mid = x.filtered[k:n - k]
        if name == "c":
            np.testing.assert_allclose(mid, 4.0)
        elif name == "slow":
            np.testing.assert_allclose(mid, x.value[k:n - k], atol=0.03)
        elif name == "fast":
            assert mid.abs().max() < 0.03
        else:
            assert x.filtered[100 - k:100 + k + 1].isna().all() and mid.notna().sum() == n - 2 * k - (2 * k + 1)
    g = W.gaussian_smooth(to_spark(spark, const), K, 3600, 2.0).toPandas()
    np.testing.assert_allclose(g.filtered, 4.0)


def test_level_of_units(spark):
    rows = [("p", "x", "2024-01-01 00:00", 1, "S/D", 100.0), ("p", "x", "2024-01-01 00:00", 2, "I/S", 50.0), ("p", "x", "2024-01-01 01:00", 1, "I/S", 100.0),
            ("p", "x", "2024-01-01 02:00", 1, "T/S", 100.0), ("p", "x", "2024-01-01 03:00", 2, "S/D,x", 50.0), ("p", "x", "2024-01-01 03:00", 1, "S/D", 100.0)]
    d = make(spark, rows, "station string, param string, t string, unit int, status string, capacity double").withColumn("ts", F.to_timestamp_ntz("t"))
    out = W.cumulative_level(d, ["station", "param"], status_map={"S/D": 0, "I/S": 1}, seconds=3600).orderBy("ts").collect()
    assert [(r.ts.hour, r.level) for r in out] == [(0, 50.0), (1, 150.0), (3, 0.0)]


def test_exact_quantiles_with_ties(spark):
    pdf = random_series(3, n=900)
    pdf.loc[pdf.index % 3 == 0, "value"] = 1.0  # one value holds a third of the rows
    q = exact_quantiles(to_spark(spark, pdf), K, {"a": 0.03, "b": 0.5, "c": 0.977}).toPandas().set_index("station")
    for st, s in pdf.groupby("station").value:
        np.testing.assert_allclose(q.loc[st, ["a", "b", "c"]].astype(float), s.quantile([0.03, 0.5, 0.977]))
