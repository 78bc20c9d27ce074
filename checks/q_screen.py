"""SCR, UDF-2 and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import HOURLY, K, OBS, UP, WH, hourly, obs, query, r6, table, width
from checks.q_windows import _GAPS, _GOOD, _REG
from tidewell.operators import grid as G, screen as S, aggs as A


@query("scr1_bounds_test", f"WITH {OBS} SELECT station, param, ts, seq, value, (value IS NOT NULL AND NOT (value BETWEEN 2 AND 120)) AS anomaly FROM obs")
def _(spark, sf):
    return S.bounds_test(obs(spark, sf), K, bounds=(2, 120))


def stepped(spark, sf, w=60):
    return hourly(spark, sf).withColumn("value", F.floor(F.col("value") / w).cast("double"))


def _runs(src, value="value"):
    return f"""c AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR {value} IS DISTINCT FROM lag({value}) OVER ({WH}) THEN 1 ELSE 0 END AS new FROM {src}),
g AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM c), r AS (SELECT *, count(*) OVER (PARTITION BY station, param, grp) AS run FROM g)"""


@query("scr2_repeat_test", f"WITH {HOURLY}, v AS (SELECT station, param, ts, floor(value / 60) AS value FROM hourly), {_runs('v')} SELECT station, param, ts, value, coalesce(value IS NOT NULL AND run > 3 AND value < 2, false) AS anomaly FROM r")
def _(spark, sf):
    return S.repeat_test(stepped(spark, sf), K, max_repeat=3, upper_limit=2, seconds=width(spark, sf))


@query("scr3_short_run_test", _GOOD + " SELECT station, param, ts, value, (value IS NOT NULL AND good_run < 3) AS anomaly FROM good")
def _(spark, sf):
    return S.short_run_test(hourly(spark, sf), K, small_gap_len=2, min_run_len=3, seconds=width(spark, sf))


@query("scr4_dip_test", f"""WITH {HOURLY}, n AS (SELECT *, lag(value) OVER ({WH}) AS p, lead(value) OVER ({WH}) AS q, lag(ts) OVER ({WH}) AS tp, lead(ts) OVER ({WH}) AS tq FROM hourly)
SELECT station, param, ts, value, coalesce(value < 20 AND tp IS NOT NULL AND tq IS NOT NULL AND (p IS NULL OR p - value > 15) AND (q IS NULL OR q - value > 15), false) AS anomaly FROM n""")
def _(spark, sf):
    return S.dip_test(hourly(spark, sf), K, low=20.0, dip=15.0, seconds=width(spark, sf))


def _med(src, frame, level=2.0, lo=0.05, hi=0.95, scale=0.0):
    return f"""m AS (SELECT *, value - median(value) OVER ({WH} {frame}) AS res FROM {src}), q AS (SELECT station, param, greatest(quantile_cont(res, {hi}) - quantile_cont(res, {lo}), {scale}) AS sc FROM m GROUP BY ALL),
t AS (SELECT m.station, m.param, m.ts, m.value, coalesce(abs(res) > {level} * sc, false) AS hit FROM m JOIN q USING (station, param))"""


_C3 = "ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING"


def _u(spark, sf):
    """Hourly maximum with all values kept, so that outliers are there to find."""
    e = table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("station"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("param"),
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("value"))


_U = "u AS (SELECT event_type AS station, 'p' || (user_id % 3) AS param, date_trunc('hour', ts) AS ts, max(value) AS value FROM events GROUP BY ALL)"


@query("scr5_median_twoside", f"WITH {_U}, {_med('u', _C3, 1.0)} SELECT station, param, ts, value, hit AS anomaly FROM t")
def _(spark, sf):
    return S.median_test_twoside(_u(spark, sf), K, level=1.0, filt_len=7, quantiles=(0.05, 0.95), seconds=width(spark, sf))


for _rev, _frame in ((False, "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"), (True, "ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING")):
    @query(f"scr6_median_oneside_{'reverse' if _rev else 'forward'}", f"WITH {_U}, {_med('u', _frame, 1.0)} SELECT station, param, ts, value, hit AS anomaly FROM t")
    def _(spark, sf, rev=_rev):
        return S.median_test_oneside(_u(spark, sf), K, level=1.0, filt_len=5, quantiles=(0.05, 0.95), reverse=rev, seconds=width(spark, sf))


@query("scr7_med_outliers", f"WITH {_U}, x AS (SELECT station, param, ts, CASE WHEN value BETWEEN 0 AND 250 THEN value END AS value FROM u), {_med('x', _C3, 1.0, scale=120.0)} SELECT station, param, ts, CASE WHEN NOT hit THEN value END AS value FROM t")
def _(spark, sf):
    return S.med_outliers(_u(spark, sf), K, level=1.0, scale=120.0, filt_len=7, quantiles=(0.05, 0.95), bounds=(0, 250), seconds=width(spark, sf))


_LOF = f"""WITH {_U}, d AS (SELECT station, param, value, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY ALL),
x AS (SELECT station, param, value, c, row_number() OVER (PARTITION BY station, param ORDER BY value, c) AS i, count(*) OVER (PARTITION BY station, param) AS m FROM (SELECT *, unnest(range(least(n, 6))) AS c FROM d)),
nb AS (SELECT a.station, a.param, a.i, b.i AS j, abs(b.value - a.value) AS dist, row_number() OVER (PARTITION BY a.station, a.param, a.i ORDER BY abs(b.value - a.value), b.i) AS r, a.m FROM x a JOIN x b ON a.station = b.station AND a.param = b.param AND b.i BETWEEN a.i - 5 AND a.i + 5 AND b.i <> a.i),
near AS (SELECT * FROM nb WHERE r <= least(5, m - 1)), kd AS (SELECT station, param, i, max(dist) AS k FROM near GROUP BY ALL),
den AS (SELECT n.station, n.param, n.i, 1 / (avg(greatest(n.dist, kd.k)) + 1e-10) AS de FROM near n JOIN kd ON kd.station = n.station AND kd.param = n.param AND kd.i = n.j GROUP BY ALL),
lf AS (SELECT n.station, n.param, n.i, avg(e.de) AS around FROM near n JOIN den e ON e.station = n.station AND e.param = n.param AND e.i = n.j GROUP BY ALL),
lof AS (SELECT x.station, x.param, x.value, coalesce(around / de, 1) AS lof FROM x LEFT JOIN lf USING (station, param, i) LEFT JOIN den USING (station, param, i) WHERE c = 0),
cut AS (SELECT station, param, quantile_cont(-lof, 0.02) AS cut FROM u JOIN lof USING (station, param, value) GROUP BY ALL)
SELECT u.station, u.param, u.ts, u.value, coalesce(-lof < cut, false) AS anomaly FROM u LEFT JOIN lof USING (station, param, value) LEFT JOIN cut USING (station, param)"""


@query("scr8_detect_lof", _LOF)
def _(spark, sf):
    return S.detect_lof(_u(spark, sf), K, 5, 0.02)


@query("scr8_quantiles", f"WITH {_U} SELECT station, param, round(quantile_cont(value, 0.03), 6) AS lo, round(quantile_cont(value, 0.5), 6) AS mid, round(quantile_cont(value, 0.97), 6) AS hi FROM u GROUP BY ALL")
def _(spark, sf):
    q = A.exact_quantiles(_u(spark, sf), K, {"lo": 0.03, "mid": 0.5, "hi": 0.97})
    return q.select(*K, *[r6(F.col(c)).alias(c) for c in ("lo", "mid", "hi")])


STEPS = [
    {"method": "bounds_test", "args": {"bounds": [1.0, 140.0]}, "apply_immediately": True},
    {"method": "short_run_test", "args": {"small_gap_len": 2, "min_run_len": 2}},
    {"method": "repeat_test", "args": {"max_repeat": 1}},
    {"method": "median_test_twoside", "args": {"level": 1.0, "filt_len": 7, "quantiles": [0.05, 0.95]}},
]
_SCREEN = f"""{HOURLY}, b AS (SELECT *, (value IS NOT NULL AND NOT (value BETWEEN 1 AND 140)) AS bounds_test FROM hourly),
wk AS (SELECT station, param, ts, value AS raw, CASE WHEN NOT bounds_test THEN value END AS value, bounds_test FROM b),
wn AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR (value IS NULL) <> (lag(value) OVER ({WH}) IS NULL) THEN 1 ELSE 0 END AS new FROM wk),
wg AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM wn), wl AS (SELECT *, (value IS NOT NULL OR count(*) OVER (PARTITION BY station, param, grp) <= 2) AS ok FROM wg),
w2 AS (SELECT * EXCLUDE (new, grp), CASE WHEN row_number() OVER ({WH}) = 1 OR ok <> lag(ok) OVER ({WH}) THEN 1 ELSE 0 END AS new FROM wl),
w3 AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM w2), w4 AS (SELECT * EXCLUDE (new, grp), (value IS NOT NULL AND count(*) OVER (PARTITION BY station, param, grp) < 2) AS short_run_test FROM w3),
w5 AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR value IS DISTINCT FROM lag(value) OVER ({WH}) THEN 1 ELSE 0 END AS new FROM w4),
w6 AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM w5), w7 AS (SELECT * EXCLUDE (new, grp), (value IS NOT NULL AND count(*) OVER (PARTITION BY station, param, grp) > 1) AS repeat_test FROM w6),
w8 AS (SELECT *, value - median(value) OVER ({WH} {_C3}) AS res FROM w7), wq AS (SELECT station, param, quantile_cont(res, 0.95) - quantile_cont(res, 0.05) AS sc FROM w8 GROUP BY ALL),
scr AS (SELECT w8.station, w8.param, ts, raw AS value, bounds_test, short_run_test, repeat_test, coalesce(abs(res) > 1.0 * sc, false) AS median_test_twoside FROM w8 JOIN wq USING (station, param)),
flagged AS (SELECT *, CASE WHEN bounds_test OR short_run_test OR repeat_test OR median_test_twoside THEN CAST(1 AS TINYINT) END AS user_flag FROM scr)"""


@query("scr9_screen", f"WITH {_SCREEN} SELECT * FROM flagged")
def _(spark, sf):
    return S.screen(hourly(spark, sf), K, STEPS, seconds=width(spark, sf))


CONFIG = {
    "defaults": {"global": {"steps": STEPS}, "params": {
        "p1": {"inherits_global": True, "modify_steps": [{"method": "bounds_test", "args": {"bounds": [5.0, 90.0]}, "apply_immediately": True}], "omit_steps": ["median_test_twoside"]},
        "p2": {"inherits_global": True, "modify_steps": "None"}}},
    "regions": {"default": {"params": {}}, "delta": {"params": {"p2": {"inherits_global": True, "omit_steps": ["repeat_test"]}}}},
    "stations": {"signup": {"params": {"p1": {"inherits_global": False, "steps": [{"method": "bounds_test", "args": {"bounds": [0.0, 50.0]}}]}}}},
}


def inventory(spark, sf):
    """One row per series."""
    return obs(spark, sf).select(*K).distinct().withColumn("region", F.when(F.col("station") == "view", "delta").otherwise("default"))


@query("scr10_resolve_protocol", f"""WITH {OBS}, k AS (SELECT DISTINCT station, param FROM obs)
SELECT station, param, CASE WHEN station = 'signup' AND param = 'p1' THEN 'bounds_test' WHEN param = 'p1' THEN 'bounds_test,short_run_test,repeat_test'
 WHEN param = 'p2' AND station = 'view' THEN 'bounds_test,short_run_test,median_test_twoside' ELSE 'bounds_test,short_run_test,repeat_test,median_test_twoside' END AS steps,
 CASE WHEN station = 'signup' AND param = 'p1' THEN '[0.0, 50.0]' WHEN param = 'p1' THEN '[5.0, 90.0]' ELSE '[1.0, 140.0]' END AS bounds FROM k""")
def _(spark, sf):
    t = S.protocol_table(spark, CONFIG, inventory(spark, sf))
    return t.groupBy(*K).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda x: x["label"]), ",").alias("steps"),
                             F.max(F.col("args")["bounds"]).alias("bounds"))


_SP1 = "(station = 'signup' AND param = 'p1')"
_BY_SERIES = _SCREEN.split(",\nflagged AS")[0].replace("value BETWEEN 1 AND 140", f"value BETWEEN CASE WHEN {_SP1} THEN 0 WHEN param = 'p1' THEN 5 ELSE 1 END AND CASE WHEN {_SP1} THEN 50 WHEN param = 'p1' THEN 90 ELSE 140 END")


@query("scr11_auto_screen", f"""WITH {_BY_SERIES} SELECT station, param, ts, value, CASE WHEN bounds_test OR (short_run_test AND NOT {_SP1}) OR (repeat_test AND NOT {_SP1} AND NOT (station = 'view' AND param = 'p2'))
 OR (median_test_twoside AND param <> 'p1') THEN CAST(1 AS TINYINT) END AS user_flag FROM scr""")
def _(spark, sf):
    return S.auto_screen(hourly(spark, sf), CONFIG, inventory(spark, sf), seconds=width(spark, sf))


@query("scr12_apply_flags", f"WITH {OBS} SELECT station, param, ts, seq, CASE WHEN seq % 9 = 0 THEN NULL ELSE value END AS value FROM obs")
def _(spark, sf):
    d = obs(spark, sf).withColumn("user_flag", F.when(F.col("seq") % 9 == 0, 1).when(F.col("seq") % 9 == 1, 0).cast("tinyint"))
    return d.select(*K, "ts", "seq", S.apply_flags().alias("value"))


@query("scr13_remove_isolated", _GAPS + " SELECT station, param, ts, CASE WHEN good_len >= 2 THEN value END AS value FROM l")
def _(spark, sf):
    return S.remove_isolated(hourly(spark, sf), K, 2, seconds=width(spark, sf))


@query("udf2_user_method", f"WITH {OBS} SELECT station, param, date_trunc('hour', ts) AS ts, CASE WHEN max(value) > 100 AND hour(date_trunc('hour', ts)) = 3 THEN CAST(1 AS TINYINT) END AS user_flag FROM obs GROUP BY station, param, date_trunc('hour', ts)")
def _(spark, sf):
    from checks.base import hourly_rows

    def night_spike(df, keys, out, value, seconds, limit):
        return df.withColumn(out, F.coalesce((F.col(value) > limit) & (F.hour("ts") == 3), F.lit(False)))

    if "night_spike" not in S.METHODS:
        S.register_method("night_spike", night_spike)
    s = S.screen(hourly_rows(spark, sf), K, [{"method": "night_spike", "args": {"limit": 100}}], seconds=width(spark, sf))
    return s.select(*K, "ts", "user_flag")


_ENTRY_REG = _REG.replace("1800000000", "3600000000")


@query("entry_screened_daily", f"""WITH {_ENTRY_REG}, c AS (SELECT *, (value IS NOT NULL AND NOT (value BETWEEN 1 AND 140)) AS b FROM reg), wk AS (SELECT station, param, ts, CASE WHEN NOT b THEN value END AS value, b FROM c),
w5 AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR value IS DISTINCT FROM lag(value) OVER ({WH}) THEN 1 ELSE 0 END AS new FROM wk), w6 AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM w5),
w7 AS (SELECT station, param, date_trunc('day', ts) AS ts, CASE WHEN NOT (value IS NOT NULL AND count(*) OVER (PARTITION BY station, param, grp) > 1) THEN value END AS value FROM w6)
SELECT station, param, ts, round(avg(value), 6) AS value FROM w7 GROUP BY ALL""")
def entry_screened_daily(spark, sf):
    r = G.regularize(obs(spark, sf), K, 3600)
    steps = [STEPS[0], {"method": "repeat_test", "args": {"max_repeat": 1}}]
    s = S.screen(r, K, steps, seconds=width(spark, sf), labels=False)
    v = s.select(*K, "ts", S.apply_flags().alias("value"))
    return A.resample_mean(v, K, 86400).withColumn("value", r6(F.col("value")))
