"""PRD queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.base import DAILY, HOURLY, K, OBS, UP, WH, daily, hourly, obs, query, r6, table, width
from checks.q_catalog import REG, registry
from checks.q_merge import PROV, providers
from checks.q_windows import DISAGG, LEVEL, PUMPS, pump_events
from tidewell.operators.aggs import bucket_of
from tidewell.plans import products as P, recipe as R
from tidewell.schema import ntz

_F = {"value": 6}


def rounded(d, *cols):
    for c in cols:
        d = d.withColumn(c, r6(F.col(c)))
    return d


def yx(spark, sf):
    """y: hourly series with gaps; x: a linear relative of the next hour, with other gaps."""
    y = hourly(spark, sf)
    x = y.select(*K, "ts", F.when(F.hour("ts") % 7 != 0, F.coalesce("value", F.lit(12.0)) * 2 + 5).alias("value"))
    return y, x


_YX = HOURLY + ", x AS (SELECT station, param, ts, CASE WHEN hour(ts) % 7 <> 0 THEN coalesce(value, 12.0) * 2 + 5 END AS value FROM hourly)"


@query("prd1_regression_impute", f"""WITH {_YX}, b AS (SELECT station, param, ts, h.value AS y, x.value AS x FROM hourly h FULL JOIN x USING (station, param, ts)),
f AS (SELECT station, param, regr_slope(y, x) AS m, regr_intercept(y, x) AS c FROM b WHERE day(ts) > 3 GROUP BY ALL)
SELECT station, param, ts, round(coalesce(y, m * x + c), 6) AS value, round(m * x + c, 6) AS predicted FROM b JOIN f USING (station, param)""")
def _(spark, sf):
    y, x = yx(spark, sf)
    return rounded(P.regression_impute(y, x, K, F.dayofmonth("ts") > 3, width(spark, sf)), "value", "predicted")


_TIDAL = f"""{HOURLY}, src AS (SELECT station, param, ts, CASE WHEN day(ts) NOT IN (11, 12) THEN coalesce(value, 20.0) END AS o, coalesce(value, 20.0) AS p, coalesce(value, 20.0) * 2 + 1 AS n FROM hourly),
tap AS (SELECT j, (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * 2 * j / 12.0) / (pi() * 2 * j / 12.0) END) * (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * j / 19.0) / (pi() * j / 19.0) END) AS w0 FROM range(-18, 19) t(j)),
tapn AS (SELECT j, w0 / (SELECT sum(w0) FROM tap) AS w FROM tap),
f AS (SELECT a.station, a.param, a.ts, a.o, CASE WHEN count(b.o) = 37 THEN sum(b.o * w) END AS so, CASE WHEN count(b.n) = 37 THEN sum(b.n * w) END AS sn, CASE WHEN count(b.p) = 37 THEN a.p - sum(b.p * w) END AS tide
 FROM src a CROSS JOIN tapn LEFT JOIN src b ON b.station = a.station AND b.param = a.param AND b.ts = a.ts + to_hours(j) GROUP BY a.station, a.param, a.ts, a.o, a.p),
fit AS (SELECT station, param, regr_slope(so, sn) AS m, regr_intercept(so, sn) AS c FROM f GROUP BY ALL), x AS (SELECT f.*, so AS p, m * sn + c AS s, epoch_us(ts) AS t FROM f JOIN fit USING (station, param)),
e AS (SELECT *, last_value(CASE WHEN p IS NOT NULL THEN {{'d': p - s, 't': t}} END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a,
 first_value(CASE WHEN p IS NOT NULL THEN {{'d': p - s, 't': t}} END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b FROM x),
g AS (SELECT *, least(6 * 3600000000, coalesce(b.t - a.t, 6 * 3600000000)) AS len FROM e),
bl AS (SELECT station, param, ts, o, tide, coalesce(p, s + coalesce(greatest(1 - (t - a.t) / len, 0.0) * a.d, 0) + coalesce(greatest(1 - (b.t - t) / len, 0.0) * b.d, 0)) AS value, row_number() OVER ({WH}) AS pos FROM g),
fl AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS va, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS vb, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM bl)"""


@query("prd2_tidal_gap_fill", f"WITH {_TIDAL} SELECT station, param, ts, round(coalesce(o, coalesce(value, va + (vb - va) * (pos - pa) / (pb - pa), va) + tide), 4) AS value FROM fl")
def _(spark, sf):
    y, x = yx(spark, sf)
    full = y.withColumn("value", F.coalesce("value", F.lit(20.0)))
    holed = full.withColumn("value", F.when(~F.dayofmonth("ts").isin(11, 12), F.col("value")))
    return P.tidal_gap_fill(holed, full, full.withColumn("value", F.col("value") * 2 + 1), K, 3600, 12 * 3600, 6 * 3600, seconds=width(spark, sf)).withColumn("value", F.round("value", 4))


@query("prd3_neighbour_fill", f"""WITH {HOURLY}, x AS (SELECT station, param, ts - INTERVAL 2 HOUR AS ts, coalesce(value, hour(ts)) * 3 + 1 AS value FROM hourly),
b AS (SELECT station, param, ts, h.value AS y, x.value AS x FROM hourly h FULL JOIN (SELECT station, param, ts + INTERVAL 2 HOUR AS ts, value FROM x) x USING (station, param, ts)),
f AS (SELECT station, param, regr_slope(y, x) AS m, regr_intercept(y, x) AS c FROM b GROUP BY ALL)
SELECT station, param, ts, round(coalesce(y, m * x + c), 6) AS value, round(m * x + c, 6) AS predicted FROM b JOIN f USING (station, param)""")
def _(spark, sf):
    y = hourly(spark, sf)
    x = y.select(*K, (F.col("ts") - F.expr("INTERVAL 2 HOURS")).alias("ts"), (F.coalesce("value", F.hour("ts").cast("double")) * 3 + 1).alias("value"))
    return rounded(P.neighbour_fill(y, x, K, 4, 3600, width(spark, sf)), "value", "predicted")


@query("prd4_flow_difference", f"""WITH {HOURLY}, d AS (SELECT station, param, ts - INTERVAL 3 HOUR AS ts, value * 3 + 50 - value AS value FROM hourly), n AS (SELECT *, row_number() OVER ({WH}) AS pos FROM d),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM n)
SELECT station, param, ts, round(coalesce(value, CASE WHEN pos - pa <= 4 THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END), 6) AS value FROM f""")
def _(spark, sf):
    h = hourly(spark, sf)
    d = P.flow_difference(h.withColumn("value", F.col("value") * 3 + 50), h, K, seconds=width(spark, sf))
    return rounded(d, "value")


def _interpolated(src: str, dst: str, limit: int | None = None) -> str:
    """SQL of linear gap filling by position, the last value held at the end."""
    ahead = f"OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    near = f"pos - pa <= {limit}" if limit else "true"
    return f"""{dst}_n AS (SELECT *, row_number() OVER ({WH}) AS pos FROM {src}),
{dst}_f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) {ahead} AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {ahead} AS pb FROM {dst}_n),
{dst} AS (SELECT station, param, ts, coalesce(value, CASE WHEN {near} THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END) AS value FROM {dst}_f)"""


@query("prd4_prepared_flow", f"""WITH {HOURLY}, d0 AS (SELECT station, param, ts, CASE WHEN hour(ts) <> 5 THEN value * 3 + 500 END AS value FROM hourly), {_interpolated("d0", "d1", 20)},
tap AS (SELECT j, (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * 2 * j / 40.0) / (pi() * 2 * j / 40.0) END) * (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * j / 61.0) / (pi() * j / 61.0) END) AS w0 FROM range(-60, 61) t(j)),
tapn AS (SELECT j, w0 / (SELECT sum(w0) FROM tap) AS w FROM tap),
d2 AS (SELECT a.station, a.param, a.ts, CASE WHEN count(b.value) = 121 THEN sum(b.value * w) END AS value FROM d1 a CROSS JOIN tapn LEFT JOIN d1 b ON b.station = a.station AND b.param = a.param AND b.ts = a.ts + to_hours(j) GROUP BY ALL),
{_interpolated("d2", "d3")}, {_interpolated("hourly", "t1")},
df AS (SELECT d3.station, d3.param, d3.ts - INTERVAL 3 HOUR AS ts, d3.value - t1.value AS value FROM d3 JOIN t1 USING (station, param, ts)), {_interpolated("df", "d4", 4)}
SELECT station, param, ts, round(value, 5) AS value FROM d4""")
def _(spark, sf):
    h = hourly(spark, sf)
    down = h.withColumn("value", F.when(F.hour("ts") != 5, F.col("value") * 3 + 500))
    d = P.prepared_flow_difference(down, h, K, 3600, seconds=width(spark, sf), strict=False)
    return d.withColumn("value", F.round("value", 5))


@query("prd8_fill_flows", f"""WITH {HOURLY}, own AS (SELECT station, param, ts, CASE WHEN hour(ts) % 6 < 3 THEN value * 60 END AS value FROM hourly), oth AS (SELECT station, param, ts, value * 50 AS value FROM hourly WHERE hour(ts) % 4 = 1),
c0 AS (SELECT own.station, own.param, own.ts, coalesce(own.value, oth.value - 200) AS value FROM own LEFT JOIN oth USING (station, param, ts)), {_interpolated("c0", "c1", 20)},
t0 AS (SELECT own.station, own.param, own.ts, coalesce(own.value, oth.value) AS value FROM own LEFT JOIN oth USING (station, param, ts)), {_interpolated("t0", "t1")}
SELECT station, param, ts, round(c1.value, 6) AS channel, round(t1.value, 6) AS total FROM c1 JOIN t1 USING (station, param, ts)""")
def _(spark, sf):
    h, w = hourly(spark, sf), width(spark, sf)
    own = h.withColumn("value", F.when(F.hour("ts") % 6 < 3, F.col("value") * 60))
    other = h.filter(F.hour("ts") % 4 == 1).withColumn("value", F.col("value") * 50)
    c = P.fill_channel_flow(own, other, K, seconds=w).withColumnRenamed("value", "channel")
    return rounded(c.join(P.fill_total_flow(own, other, K, w).withColumnRenamed("value", "total"), [*K, "ts"]), "channel", "total")


@query("prd5_daily_to_fine", f"""WITH {DAILY}, dg AS (SELECT station, param, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM daily GROUP BY station, param),
n5 AS (SELECT station, param, ts, d.value, row_number() OVER (PARTITION BY station, param ORDER BY ts) AS pos, CASE WHEN station < '3' THEN 1 ELSE 4 END AS lim, CASE WHEN station < '3' THEN 10.0 ELSE 0.0 END::DOUBLE AS k FROM dg LEFT JOIN daily d USING (station, param, ts)),
g5 AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM n5),
daily2 AS (SELECT station, param, ts, coalesce(value, CASE WHEN pos - pa <= lim THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END) + k AS value FROM g5),
{DISAGG.replace('FROM daily WINDOW', 'FROM daily2 WINDOW')}
SELECT station, param, ts, round(least(greatest(value - CASE WHEN station < '3' THEN 10.0 ELSE 0.0 END, 0), 900000)::DOUBLE, 4) AS value FROM fine WHERE value IS NOT NULL""")
def _(spark, sf):
    from tidewell.operators.grid import asfreq
    d = asfreq(daily(spark, sf), K, 86400)
    low = F.col("station") < "3"
    p = daily(spark, sf).select(*K).distinct().select(*K, F.when(low, 1).otherwise(4).alias("limit_rows"), F.when(low, 10.0).otherwise(0.0).alias("add"), F.when(low, 10.0).otherwise(0.0).alias("subtract"),
                                                      F.lit(0.0).alias("low"), F.lit(900000.0).alias("high"))
    return P.daily_to_fine_flow(d, p, K, 86400, 9600).withColumn("value", F.round("value", 4))


@query("prd6_threshold_zero", f"""WITH {HOURLY}, g AS (SELECT station, param, unnest(generate_series(min(ts), max(ts), INTERVAL 30 MINUTE)) AS ts FROM hourly GROUP BY station, param),
x AS (SELECT g.station, g.param, g.ts, h.value, row_number() OVER (PARTITION BY station, param ORDER BY ts) AS pos FROM g LEFT JOIN hourly h USING (station, param, ts)),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM x),
v AS (SELECT station, param, ts, coalesce(value, CASE WHEN pos - pa <= 3 THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END) AS v FROM f)
SELECT station, param, ts, round(CASE WHEN v < 50 OR v IS NULL THEN 0 ELSE v END, 6) AS value FROM v""")
def _(spark, sf):
    return rounded(P.threshold_zero_flow(hourly(spark, sf), K, 1800, 50.0, 3, seconds=width(spark, sf)), "value")


@query("prd7_interpolated_flow", f"""WITH {HOURLY}, n AS (SELECT *, row_number() OVER ({WH}) AS pos FROM hourly),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM n),
v AS (SELECT station, param, ts, coalesce(value, a + (b - a) * (pos - pa) / (pb - pa), a) AS v, ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-09 12:00:00' AS i FROM f)
SELECT station, param, ts, round(CASE WHEN i THEN avg(v) FILTER (i) OVER (PARTITION BY station, param) ELSE v END, 6) AS value FROM v""")
def _(spark, sf):
    return rounded(P.interpolated_flow(hourly(spark, sf), K, "2024-01-08 00:00:00", "2024-01-09 12:00:00", width(spark, sf)), "value")


@query("prd8_split_bypass", f"""WITH {HOURLY}, w AS (SELECT station, param, ts, CASE WHEN hour(ts) % 4 <> 1 THEN value * 60 END AS toe, CASE WHEN hour(ts) % 3 = 0 THEN value / 8 END AS elev, coalesce(value, 30) * 80 AS total, row_number() OVER ({WH}) AS pos FROM hourly),
c AS (SELECT *, coalesce(last_value(CASE WHEN elev IS NOT NULL OR toe IS NOT NULL THEN coalesce(elev > 11.5, false) OR coalesce(toe > 4000, false) END IGNORE NULLS) OVER ({WH} {UP} CURRENT ROW), false) AS active,
 last_value(toe IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN toe IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(toe IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN toe IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM w),
v AS (SELECT *, CASE WHEN active THEN toe ELSE coalesce(toe, a + (b - a) * (pos - pa) / (pb - pa), a) END AS tv FROM c),
t AS (SELECT *, CASE WHEN active THEN total ELSE tv END AS tot, CASE WHEN tv IS NULL AND active THEN 4000 WHEN tv IS NULL THEN NULL ELSE least(tv, 4000) END::DOUBLE AS eff FROM v),
e AS (SELECT *, CASE WHEN coalesce(tot <= 4000, false) THEN eff ELSE eff + 0.05::DOUBLE * (tot - eff) END AS toe_eff FROM t)
SELECT station, param, ts, active, round(toe_eff, 6) AS toe_eff, round(CASE WHEN tot <= 4000 THEN 0 ELSE CASE WHEN tot - toe_eff IS NULL THEN 0 ELSE greatest(tot - toe_eff, 0) END END, 6) AS bypass_eff FROM e""")
def _(spark, sf):
    h = hourly(spark, sf)
    toe = h.select(*K, "ts", F.when(F.hour("ts") % 4 != 1, F.col("value") * 60).alias("value"))
    elev = h.select(*K, "ts", F.when(F.hour("ts") % 3 == 0, F.col("value") / 8).alias("value"))
    total = h.select(*K, "ts", (F.coalesce("value", F.lit(30.0)) * 80).alias("value"))
    return rounded(P.split_bypass_flow(toe, elev, total, K, seconds=width(spark, sf)), "toe_eff", "bypass_eff")


@query("prd9_exports", f"""WITH {LEVEL}, lv AS (SELECT station, param, ts, level FROM pl WHERE moved = 1), lim AS (SELECT station, param, time_bucket(INTERVAL 15 MINUTE, min(ts) + INTERVAL 899 SECOND, TIMESTAMP '1970-01-01') AS a, time_bucket(INTERVAL 15 MINUTE, max(ts), TIMESTAMP '1970-01-01') AS b FROM lv GROUP BY ALL),
g0 AS (SELECT station, param, unnest(generate_series(a, b, INTERVAL 15 MINUTE)) AS ts FROM lim), g AS (SELECT g0.station, g0.param, g0.ts, lv.level AS value FROM g0 ASOF LEFT JOIN lv ON g0.station = lv.station AND g0.ts >= lv.ts),
tap AS (SELECT j, exp(-0.5 * (j / 2.0) * (j / 2.0)) AS w0 FROM range(-8, 9) t(j)), tapn AS (SELECT j, w0 / (SELECT sum(w0) FROM tap) AS w FROM tap),
f AS (SELECT x.station, x.param, x.ts, sum(b.value * w) AS value FROM g x JOIN lim USING (station, param) CROSS JOIN tapn JOIN g b ON b.station = x.station AND b.ts = least(greatest(x.ts + to_minutes(15 * j), lim.a), lim.b) GROUP BY ALL)
SELECT station, param, ts, round(value + 100, 5) AS cfs, round((value + 100) * 0.028316846592::DOUBLE, 5) AS cms FROM f""")
def _(spark, sf):
    ev = pump_events(spark, sf)
    # the second series has every step of the days that the events cover
    days = ev.groupBy("station").agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("a"), F.date_trunc("day", F.max("ts")).cast("timestamp_ntz").alias("b"))
    days = days.select("station", F.explode(F.expr("sequence(a, b, INTERVAL 1 DAY)")).alias("d"))
    second = days.select("station", F.lit("plant").alias("param"), F.explode(F.expr("sequence(d, d + INTERVAL '23:45' HOUR TO MINUTE, INTERVAL 15 MINUTES)")).alias("ts"), F.lit(100.0).alias("value"))
    d = P.exports(ev.drop("tie").withColumn("tie", F.col("seq")), second, K, PUMPS, 900, 2.0, width(spark, sf), tie="seq")
    return d.withColumn("cfs", F.round("cfs", 5)).withColumn("cms", F.round("cms", 5))


@query("prd9_daily_difference", f"WITH {OBS}, d AS (SELECT station, param, date_trunc('day', ts) AS ts, avg(value) AS derived, max(value) AS published FROM obs GROUP BY ALL) SELECT station, param, ts, round(derived, 6) AS derived, published, round(derived - published, 6) AS difference FROM d")
def _(spark, sf):
    o = obs(spark, sf)
    pub = o.groupBy(*K, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("value"))
    return rounded(P.daily_difference(o, pub, K), "derived", "difference")


@query("prd10_boundary_table", f"""WITH {PROV}, w AS (SELECT station, param, ts, max(value) FILTER (p = 0) AS a, max(value) FILTER (p = 1) AS b, max(value) FILTER (p = 2) AS c FROM pv GROUP BY ALL), m AS (SELECT station, param, ts, CASE WHEN a BETWEEN 5 AND 100 THEN a END AS a, b, CASE WHEN c >= 2 THEN c END AS c FROM w)
SELECT station, param, ts, coalesce(a, b, c) AS a, coalesce(b, c) AS b, c, coalesce(a, b, c) AS alias_a FROM m""")
def _(spark, sf):
    return P.boundary_table(dict(zip("abc", providers(spark, sf))), {"a": (5, 100), "c": (2, None)}, {"a": ["b", "c"], "b": ["c"]}, {"alias_a": "a"}, K)


@query("prd11_waterlevel", f"""WITH {HOURLY}, o AS (SELECT station, param, ts, value + CASE WHEN param = 'p1' THEN 2.5 ELSE 0 END AS v FROM hourly), n AS (SELECT station, param, ts, CASE WHEN v BETWEEN 3 AND 120 THEN v END AS value, row_number() OVER ({WH}) AS pos FROM o),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM n)
SELECT station, param, ts, round(coalesce(value, CASE WHEN pos - pa <= 5 THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END), 6) AS value FROM f""")
def _(spark, sf):
    h = hourly(spark, sf)
    off = h.select(*K).distinct().filter("param = 'p1'").withColumn("offset", F.lit(2.5))
    return rounded(P.waterlevel_correct(h, off, K, 3, 120, 5, width(spark, sf)), "value")


@query("prd12_gate_height", """SELECT l_orderkey, l_linenumber, CAST((l_discount > 0.03)::INT + (l_tax > 0.03)::INT AS INTEGER) AS ndup,
 CASE WHEN l_discount > 0.03 OR l_tax > 0.03 THEN round(((CASE WHEN l_discount > 0.03 THEN l_discount ELSE 0 END) + (CASE WHEN l_tax > 0.03 THEN l_tax ELSE 0 END)) / ((l_discount > 0.03)::INT + (l_tax > 0.03)::INT), 3) ELSE 0 END::DOUBLE AS height FROM lineitem""")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("gate_1"), F.col("l_tax").alias("gate_2"))
    return P.gate_height(d, ["gate_1", "gate_2"])


@query("prd13_gate_log", """WITH l AS (SELECT event_type AS station, 'gate' AS param, date_trunc('hour', ts) AS ts, event_id AS seq, CASE user_id % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Tidal' ELSE 'odd' END AS gate, user_id % 5 = 0 AS act FROM events),
s AS (SELECT station, min(ts) AS t0 FROM l WHERE act AND ts >= TIMESTAMP '2024-01-15' GROUP BY ALL)
SELECT station, param, ts, last(gate ORDER BY seq) AS gate FROM l JOIN s USING (station) WHERE (NOT act AND ts < t0) OR (act AND ts >= t0) GROUP BY station, param, ts""")
def _(spark, sf):
    u = F.col("user_id")
    st = F.when(u % 4 == 0, "O").when(u % 4 == 1, "CLSD").when(u % 4 == 2, "m-op").otherwise("odd")
    e = table(spark, sf, "events").select(F.col("event_type").alias("station"), F.lit("gate").alias("param"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_id").alias("seq"), st.alias("gate"), (u % 5 == 0).alias("act"))
    return P.gate_log(e.filter("NOT act"), e.filter(F.col("act") & (F.col("ts") >= ntz("2024-01-15 00:00:00"))), K, ["gate"], seconds=width(spark, sf)).select(*K, "ts", "gate")


@query("prd14_reformat", f"""WITH {REG}, o AS (SELECT DISTINCT 's' || (o_custkey % 310) AS station_id, CASE WHEN o_orderstatus = 'P' THEN 'elev' ELSE 'flow' END AS param, o_orderdate AS ts FROM orders)
SELECT station_id, param, CAST(year(ts) // 10 * 10 AS INTEGER) AS shard_year, count(*) AS n, max(ts) AS last_ts FROM o JOIN reg USING (station_id) GROUP BY ALL HAVING count(*) >= 16""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit("s"), (F.col("o_custkey") % 310).cast("string")).alias("station_id"), F.when(F.col("o_orderstatus") == "P", "elev").otherwise("flow").alias("param"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    good, _ = P.reformat(o, registry(spark, sf), ["station_id", "param"], 86400, block_years=10, min_rows=9)
    ok = F.col("value").isNotNull()
    return good.groupBy("station_id", "param", "shard_year").agg(F.count("value").alias("n"), F.max(F.when(ok, F.col("ts"))).alias("last_ts"))


@query("prd15_split_sublocations", "SELECT event_type AS station, 'flow' AS param, CASE WHEN user_id % 2 = 0 THEN 'upper' ELSE 'default' END AS subloc, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value FROM events GROUP BY ALL")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("station"), F.lit("flow").alias("param"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "value", "user_id")
    return rounded(P.split_sublocations(e, K, bucket_of(F.when(F.col("user_id") % 2 == 0, "TOP sensor").otherwise("unnamed"))), "value")


@query("prd16_ingest_recipe", f"""WITH {PROV}, f AS (SELECT station || '_' || p || '.csv' AS file, station, p, ts, max(value) AS value FROM pv GROUP BY ALL),
lim AS (SELECT min(ts) AS s1 FROM f WHERE station = 'click' AND p = 1 AND value IS NOT NULL)
SELECT 'click' AS entry, ts, round(CASE WHEN value IS NOT NULL THEN value * 0.3048::DOUBLE END, 6) AS value, 'm' AS unit FROM f, lim WHERE station = 'click' AND ((p = 0 AND ts < s1) OR (p = 1 AND ts >= s1))
UNION ALL SELECT 'view', ts, value * 2 + 1, 'cfs' FROM f WHERE file = 'view_2.csv'
UNION ALL SELECT 'click_late', ts, value, 'cfs' FROM f WHERE file = 'click_2.csv'
UNION ALL SELECT CASE WHEN station = 'view' THEN 'view_early' ELSE station END AS entry, ts, first(value ORDER BY p DESC) FILTER (value IS NOT NULL), 'ft' FROM f
 WHERE station IN ('error', 'signup', 'purchase') OR (station = 'view' AND p < 2) GROUP BY ALL""")
def _(spark, sf):
    d = None
    for i, p in enumerate(providers(spark, sf)):
        x = p.groupBy("station", "ts").agg(F.max("value").alias("value")).select(F.concat("station", F.lit(f"_{i}.csv")).alias("file"), "ts", "value")
        d = x if d is None else d.unionByName(x)
    out = R.ingest(d, [
        {"name": "click", "pattern": "click_[01].csv", "mode": "time_overlap", "combine": "splice", "transforms": [{"name": "convert_units", "args": {"from_unit": "ft", "to_unit": "m"}}], "metadata": {"unit": "m"}},
        {"name": "view", "pattern": "view_2.csv", "transforms": [{"name": "linear", "args": {"scale": 2.0, "offset": 1.0}}], "metadata": {"unit": "cfs"}},
        {"name": "click_late", "pattern": "click_2.csv", "metadata": {"unit": "cfs"}},
        *[{"name": n, "pattern": p, "mode": "time_overlap", "combine": "merge", "metadata": {"unit": "ft"}}
          for n, p in (("view_early", "view_[01].csv"), ("error", "error_*.csv"), ("signup", "signup_*.csv"), ("purchase", "purchase_*.csv"))],
    ])
    parts = [v.select("entry", "ts", "value", "unit") for v in out.values()]
    return rounded(reduce(DataFrame.unionByName, parts), "value")
