import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import aggs as A, grid as G, merge as M
from tidewell.plans import screening as SC, series as SE
from tidewell.sources import lines as L

K = ["station"]
T0 = pd.Timestamp("2024-01-01")
OBS = "station string, provider string, shard string, ts timestamp_ntz, value double"


def rows_of(station, provider, minutes, step, n, shard="a", missing=()):
    return [(station, provider, shard, (T0 + pd.Timedelta(minutes=minutes + step * i)).to_pydatetime(), None if i in missing else round(float(np.sin(i)) * 10, 2)) for i in range(n)]


def order(spark, *names):
    stations = ["one", "two", "odd", "clash", "same"]
    return spark.createDataFrame([(s, p, i) for s in stations for i, p in enumerate(names)], "station string, provider string, prio int")


def pandas_grid(rows, seconds, method):
    s = pd.Series({r[3]: r[4] for r in rows}, dtype=float).sort_index()
    step = pd.Timedelta(seconds=seconds)
    if method == "asfreq":
        return s.reindex(pd.date_range(s.index[0], s.index[-1], freq=step))
    grid = pd.date_range(s.index[0].floor(step), s.index[-1].ceil(step), freq=step)
    return s.reindex(s.index.union(grid)).interpolate(method="time").reindex(grid).round(2)


@pytest.mark.parametrize("method", ["asfreq", "interp"])
def test_grids_of_many_steps_are_one_plan(spark, method):
    data = {"one": rows_of("one", "p", 7, 15, 200, missing={0, 1, 50, 51, 199}), "two": rows_of("two", "p", 0, 60, 90, missing={3}), "same": rows_of("same", "p", 3, 11, 40)}
    d = spark.createDataFrame([r for rows in data.values() for r in rows], OBS)
    facts = spark.createDataFrame([("one", 3600, method, 2), ("two", 1800, method, 2), ("same", None, None, None)], "station string, freq long, method string, decimals int")
    got = G.on_steps(d, K, facts, seconds=6 * 3600).toPandas()
    for station, seconds in (("one", 3600), ("two", 1800)):
        mine = got[got.station == station].set_index("ts").value.sort_index()
        want = pandas_grid(data[station], seconds, method)
        assert list(mine.index) == list(want.index)
        assert np.allclose(mine, want, atol=0.0101 if method == "interp" else 0, equal_nan=True)
    assert sorted(got[got.station == "same"].value) == sorted(r[4] for r in data["same"])


def test_collected_failures_do_not_stop_the_others(spark):
    ragged = [r for i, r in enumerate(rows_of("odd", "b", 0, 30, 90)) if i % 7 not in (2, 3, 5)]
    d = spark.createDataFrame(rows_of("one", "a", 0, 60, 50) + rows_of("one", "b", 1000, 15, 300) + rows_of("two", "a", 0, 60, 30) + rows_of("odd", "a", 0, 60, 50) + ragged
                              + rows_of("clash", "a", 0, 60, 20, "a") + rows_of("clash", "a", 600, 60, 20, "b"), OBS)
    o = order(spark, "a", "b")
    rows, failed = SE.collect_series(d, K, o, 2, policy="as_freq_finer")
    assert {(r.station, r.problem) for r in failed.collect()} == {("clash", "shards overlap in time"), ("odd", "mixed frequencies of which one is irregular")}
    assert {r.station for r in rows.select("station").distinct().collect()} == {"one", "two"}
    none = SE.collect_series(d, K, o, 2, policy=None)[1]
    assert {r.station for r in none.collect()} == {"clash"}
    with pytest.raises(ValueError, match="frequencies"):
        SE.read_series(d.filter("station = 'odd'"), K, o, 2, policy="as_freq_finer")


@pytest.mark.parametrize("policy", ["interp_to_middle", "spline_to_finer", "asfreq:0", "asfreq:x", "finer", ""])
def test_unknown_policies(policy):
    with pytest.raises(ValueError, match="unknown"):
        G.parse_policy(policy)


def test_known_policies():
    assert [G.parse_policy(p) for p in ("interp_to_finer", "as_freq_latest", "interp:900", None)] == [("interp", "finer"), ("asfreq", "latest"), ("interp", "900"), None]


def test_ingest_plan_follows_the_order_of_the_files(spark):
    steps = {"one": [3600, 3600, 900], "two": [3600, 86400], "odd": [900, 3600], "same": [900, 900], "clash": [600, 900, 360], "none": [None]}
    d = spark.createDataFrame([(s, f"f{i}", x) for s, xs in steps.items() for i, x in enumerate(xs)], "station string, file string, freq long")
    got = {r.station: (r.freq, r.method, r.problem) for r in G.ingest_plan(d, K).collect()}
    assert got == {"one": (900, "interp", None), "two": (86400, "asfreq", None), "odd": (None, None, "no rule for the steps 900,3600"), "same": (None, None, None),
                   "clash": (None, None, "no rule for the steps 600,900,360"), "none": (None, None, "irregular files")}


def test_steps_that_cannot_run():
    good = [{"method": "bounds_test", "args": {"bounds": [None, 3]}}, {"method": "repeat_test"}, {"method": "median_test_oneside", "args": {"reverse": True, "level": 2}}]
    assert [SC.step_problem(s) for s in good] == [None] * 3
    bad = [{"method": "nope"}, {"method": "dip_test", "args": {"depth": 1}}, {"method": "bounds_test", "args": {"bounds": 3}}, {"method": "repeat_test", "args": {"max_repeat": "many"}}]
    assert all(map(SC.step_problem, bad))


@pytest.mark.parametrize("ranks", [3, 60])
def test_strict_merge_of_many_ranks(spark, ranks):
    rng = np.random.default_rng(ranks)
    rows = []
    for r, station in itertools.product(range(ranks), ("one", "two")):
        a = int(rng.integers(0, 400))
        for h in range(a, a + int(rng.integers(1, 30))):
            rows.append((station, r, (T0 + pd.Timedelta(hours=h)).to_pydatetime(), None if rng.random() < 0.3 else float(r)))
    d = spark.createDataFrame(rows, "station string, r int, ts timestamp_ntz, value double")
    got = {(x.station, x.ts): x.value for x in M.merge_ranked(d, K, "r", strict_priority=True, seconds=36_000).collect()}
    t = pd.DataFrame(rows, columns=["station", "r", "ts", "value"])
    spans = t.dropna().groupby(["station", "r"]).ts.agg(["min", "max"])
    want = {}
    for x in t.sort_values("r").itertuples():
        over = [s for (st, r), s in spans.iterrows() if st == x.station and r < x.r and s["min"] <= x.ts <= s["max"]]
        if not over:
            key = (x.station, x.ts.to_pydatetime())
            if want.get(key) is None:
                want[key] = None if np.isnan(x.value) else x.value
    assert got == want


def test_files_by_their_headers(spark, tmp_path):
    files = {"a.csv": "# format: canonical-1.0\n# dtypes:\n#   mode: str\n#   'height': float\n# unit: ft\nmode,value,datetime,height\n\"x, y\",1.5,2024-01-01 00:00,7\nz,,2024-01-02 00:00,\nz,two,2024-01-03,1\n",
             "b.csv": "datetime,value,user_flag\n2024-01-01T00:00:00,3,1\nnever,3,\n2024-01-02,4,0,9\n", "c.csv": "# empty\n", "d.csv": "value\n3\n", "e.csv": ""}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, bad = L.read_headed(L.read_lines(spark, str(tmp_path)))
    assert sorted((r.file, str(r.ts), r.value, r.user_flag, r.numbers, r.texts) for r in good.collect()) == sorted([
        ("a.csv", "2024-01-01 00:00:00", 1.5, None, {"height": 7.0}, {"mode": "x, y"}), ("a.csv", "2024-01-02 00:00:00", None, None, {"height": None}, {"mode": "z"}),
        ("b.csv", "2024-01-01 00:00:00", 3.0, 1, {}, {})])
    assert sorted((r.file, r.line, r.reason) for r in bad.collect()) == [
        ("a.csv", "z,two,2024-01-03,1", "text in numeric column value"), ("b.csv", "2024-01-02,4,0,9", "wrong number of fields"), ("b.csv", "never,3,", "bad time"), ("d.csv", "3", "no time column")]


def test_flags_by_file_facts_size(spark, monkeypatch):
    monkeypatch.setattr(L, "SMALL_BYTES", 0)  # the join without a broadcast
    lines = spark.createDataFrame([("f", 0, "datetime,value"), ("f", 1, "2024-01-01,2")], "file string, line_no long, line string")
    assert [r.value for r in L.read_headed(lines)[0].collect()] == [2.0]
    assert L.read_headed(lines)[1].select(F.count("*")).first()[0] == 0


def test_null_list_of_a_series_without_values(spark):
    t = pd.Timestamp("2024-01-01")
    rows = [("a", "p", t + pd.Timedelta(hours=h), v) for h, v in enumerate([None, 1.0, None, 2.0, None])] + [("b", "p", t, None)]
    d = spark.createDataFrame([(a, b, x.to_pydatetime(), v) for a, b, x, v in rows], "station string, param string, ts timestamp_ntz, value double")
    got = sorted((((r.station, r.ts.hour), r.interior) for r in A.interior_nulls(d, ["station", "param"]).collect()), key=lambda x: x[0])
    assert got == [(("a", 0), False), (("a", 2), True), (("a", 4), False), (("b", 0), None)]
