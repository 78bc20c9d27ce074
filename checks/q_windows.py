"""FLT, AGG-1..5, WIN, TIM queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.base import (
    ORACLE,
    DAILY, HB, HOURLY, K, OBS, UP, W, WH, daily, hourly, hourly_rows, obs, query, r6, table, width,
)
from tidewell.operators import aggs as A, filters as FL, grid as G, windows as WN
from tidewell.operators.checks import require_no_nulls

# --- FLT ---------------------------------------------------------------------


@query("flt1_slice_time", f"WITH {OBS} SELECT station, param, ts, value FROM obs WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'")
def _(spark, sf):
    return FL.slice_time(obs(spark, sf).drop("seq"), "2024-01-05 06:00:00", "2024-01-20 18:00:00")


@query("flt2_prune_years", f"WITH {DAILY} SELECT station, param, ts, value, CAST(year(ts) AS INTEGER) AS shard_year FROM daily WHERE year(ts) BETWEEN 1996 AND 1998")
def _(spark, sf):
    return FL.prune_years(daily(spark, sf).withColumn("shard_year", F.year("ts")), "1996-05-01", "1998-02-01")


@query("flt3_accept_quality", """SELECT l_orderkey, l_linenumber, CASE WHEN trim(q) IN ('A', 'N') OR q IS NULL OR trim(q) = '' THEN l_quantity END AS value
FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_returnflag || ' ' WHEN l_linenumber > 4 THEN ' ' END AS q FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    q = F.when(F.col("l_linestatus") == "F", F.concat("l_returnflag", F.lit(" "))).when(F.col("l_linenumber") > 4, F.lit(" "))
    return li.withColumn("q", q).select("l_orderkey", "l_linenumber", FL.accept_quality("l_quantity", "q", ["A", "N"]).alias("value"))


@query("flt4_mean_columns", """SELECT l_orderkey, l_linenumber, round(CASE WHEN a IS NULL AND b IS NULL THEN NULL
 ELSE (coalesce(a, 0) + coalesce(b, 0)) / ((a IS NOT NULL)::INT + (b IS NOT NULL)::INT) END, 6) AS value
FROM (SELECT *, CASE WHEN l_discount > 0.02 THEN l_quantity END AS a, CASE WHEN l_tax > 0.02 THEN l_extendedprice END AS b FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    m = FL.mean_columns(F.when(F.col("l_discount") > 0.02, F.col("l_quantity")), F.when(F.col("l_tax") > 0.02, F.col("l_extendedprice")))
    return li.select("l_orderkey", "l_linenumber", r6(m).alias("value"))


@query("flt5_mask_range", f"WITH {OBS} SELECT station, param, ts, CASE WHEN value BETWEEN 5 AND 100 THEN value END AS value FROM obs")
def _(spark, sf):
    return obs(spark, sf).select(*K, "ts", FL.mask_range("value", 5, 100).alias("value"))


@query("flt6_clip", f"WITH {OBS} SELECT station, param, ts, CASE WHEN value IS NOT NULL THEN least(greatest(value, 5.0), 100.0) END::DOUBLE AS value FROM obs")
def _(spark, sf):
    return obs(spark, sf).select(*K, "ts", FL.clip("value", 5, 100).alias("value"))


@query("flt7_trim_edges", f"""WITH {HOURLY}, m AS (SELECT station, param, ts, CASE WHEN value < 40 THEN value END AS value FROM hourly),
e AS (SELECT *, min(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY station, param) AS a, max(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY station, param) AS b FROM m)
SELECT station, param, ts, value FROM e WHERE ts BETWEEN a AND b""")
def _(spark, sf):
    d = hourly(spark, sf).withColumn("value", F.when(F.col("value") < 40, F.col("value")))
    return FL.trim_edges(d, K, seconds=width(spark, sf))


@query("flt8_exclude_marked", f"WITH {OBS} SELECT station, param, ts, value FROM obs WHERE NOT (seq % 7 = 0)")
def _(spark, sf):
    d = obs(spark, sf).withColumn("exclude", F.when(F.col("seq") % 7 == 0, F.lit("X")))
    return FL.exclude_marked(d).select(*K, "ts", "value")


@query("flt9_require_no_nulls", f"WITH {HOURLY} SELECT station, param, ts, coalesce(value, 0)::DOUBLE AS value FROM hourly")
def _(spark, sf):
    return require_no_nulls(hourly(spark, sf).na.fill(0.0, ["value"]), ["value"])


# --- AGG on series -----------------------------------------------------------


@query("agg1_resample_mean", f"""WITH {OBS}, d AS (SELECT station, param, date_trunc('day', ts) AS ts, avg(CASE WHEN value < 30 THEN value END) AS value FROM obs GROUP BY ALL),
span AS (SELECT station, param, min(ts) AS a, max(ts) AS b FROM d GROUP BY ALL),
g AS (SELECT station, param, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS ts FROM span)
SELECT g.station, g.param, g.ts, round(d.value, 6) AS value FROM g LEFT JOIN d USING (station, param, ts)""")
def _(spark, sf):
    d = obs(spark, sf).withColumn("value", F.when(F.col("value") < 30, F.col("value")))
    return A.resample_mean(d, K, 86400).withColumn("value", r6(F.col("value")))


@query("agg2_sublocation_means", f"""WITH s AS (SELECT event_type AS station, 'flow' AS param, date_trunc('hour', ts) AS ts, CASE WHEN value <= 150 AND user_id % 10 <> 9 THEN value END AS value,
 CASE WHEN user_id % 10 = 4 THEN 'lower' WHEN user_id % 10 < 3 THEN 'upper' WHEN user_id % 10 < 6 THEN 'mid' WHEN user_id % 10 = 9 THEN 'default' ELSE 'lower' END AS subloc FROM events)
SELECT station, param, subloc, ts, round(avg(value), 6) AS value FROM s WHERE subloc <> 'default' GROUP BY ALL""")
def _(spark, sf):
    u = F.col("user_id") % 10
    descr = F.when(u < 3, "Upper sensor").when(u < 6, "MID depth").when(u == 9, "spare").otherwise("near bottom")
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("station"), F.lit("flow").alias("param"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        F.when((F.col("value") <= 150) & (u != 9), F.col("value")).alias("value"), A.bucket_of(descr, u.cast("string"), {"4": "lower"}).alias("subloc"))
    return A.sublocation_means(e, K).withColumn("value", r6(F.col("value")))


@query("agg3_gate_reduce", """SELECT l_orderkey, l_linenumber, CAST((l_discount > 0.03)::INT + (l_tax > 0.03)::INT AS INTEGER) AS ndup,
 CASE WHEN l_discount > 0.03 OR l_tax > 0.03 THEN round(((CASE WHEN l_discount > 0.03 THEN l_discount ELSE 0 END) + (CASE WHEN l_tax > 0.03 THEN l_tax ELSE 0 END))
   / ((l_discount > 0.03)::INT + (l_tax > 0.03)::INT), 3) ELSE 0 END::DOUBLE AS height FROM lineitem""")
def _(spark, sf):
    n, h = A.gate_reduce([F.col("l_discount"), F.col("l_tax")], 0.03)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", n.alias("ndup"), h.alias("height"))


_EDGED = f"""WITH {HOURLY}, m AS (SELECT station, param, ts, CASE WHEN value < 60 THEN value END AS value FROM hourly),
e AS (SELECT *, min(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY station, param) AS a, max(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY station, param) AS b FROM m)"""


@query("agg4_describe_null", _EDGED + " SELECT station, param, count(*) FILTER (value IS NULL) AS nulls, count(*) FILTER (value IS NULL AND ts BETWEEN a AND b) AS interior_nulls FROM e GROUP BY ALL")
def _(spark, sf):
    return A.describe_null(hourly(spark, sf).withColumn("value", F.when(F.col("value") < 60, F.col("value"))), K, seconds=width(spark, sf))


@query("agg4_null_list", _EDGED + " SELECT station, param, ts, (ts BETWEEN a AND b) AS interior FROM e WHERE value IS NULL")
def _(spark, sf):
    return A.interior_nulls(hourly(spark, sf).withColumn("value", F.when(F.col("value") < 60, F.col("value"))), K, seconds=width(spark, sf))


@query("agg5_window_mean_replace", f"""WITH {OBS}, m AS (SELECT *, avg(value) FILTER (ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00') OVER (PARTITION BY station, param) AS mean FROM obs)
SELECT station, param, ts, seq, round(CASE WHEN ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00' THEN mean ELSE value END, 6) AS value FROM m""")
def _(spark, sf):
    return A.window_mean_replace(obs(spark, sf), K, "2024-01-10 00:00:00", "2024-01-12 00:00:00", seconds=width(spark, sf)).withColumn("value", r6(F.col("value")))


# --- WIN ---------------------------------------------------------------------

_INTERP = f"""WITH {OBS}, n AS (SELECT *, row_number() OVER ({W}) AS pos FROM obs),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({W} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({W} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b,
 first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM n)"""


@query("win1_interpolate", _INTERP + """ SELECT station, param, ts, seq, value, round(coalesce(value, CASE WHEN pos - pa <= 2 THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END), 6) AS filled FROM f""")
def _(spark, sf):
    return WN.interpolate(obs(spark, sf), K, 2, order=("ts", "seq"), seconds=width(spark, sf)).withColumn("filled", r6(F.col("filled")))


@query("win2_interpolate_time", f"""WITH {OBS}, f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({W} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER ({W} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b,
 first_value(CASE WHEN value IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM obs)
SELECT station, param, ts, seq, value, round(coalesce(value, a + (b - a) * (epoch_us(ts) - pa) / (pb - pa), a), 6) AS filled FROM f""")
def _(spark, sf):
    return WN.interpolate_time(obs(spark, sf), K, order=("ts", "seq"), seconds=width(spark, sf)).withColumn("filled", r6(F.col("filled")))


@query("win3_ffill", _INTERP + " SELECT station, param, ts, seq, value, coalesce(value, CASE WHEN pos - pa <= 1 THEN a END) AS filled FROM f")
def _(spark, sf):
    return WN.ffill(obs(spark, sf), K, 1, order=("ts", "seq"), seconds=width(spark, sf))


@query("win3_bfill", _INTERP + " SELECT station, param, ts, seq, value, coalesce(value, b) AS filled FROM f")
def _(spark, sf):
    return WN.bfill(obs(spark, sf), K, None, order=("ts", "seq"), seconds=width(spark, sf))


@query("win3_fill_sweep", _INTERP + " SELECT station, param, ts, seq, value, coalesce(value, CASE WHEN pos - pa <= 1 THEN a END, CASE WHEN pb - pos <= 1 THEN b END) AS filled FROM f")
def _(spark, sf):
    return WN.fill_sweep(obs(spark, sf), K, 1, order=("ts", "seq"), seconds=width(spark, sf))


@query("win4_shift", f"WITH {OBS} SELECT station, param, ts, seq, value, lag(value, 3) OVER ({W}) AS shifted FROM obs")
def _(spark, sf):
    return WN.shift(obs(spark, sf), K, 3, order=("ts", "seq"), seconds=width(spark, sf))


@query("win4_shift_time", f"WITH {OBS} SELECT station, param, ts - INTERVAL 3 HOUR AS ts, seq, value FROM obs")
def _(spark, sf):
    return WN.shift_time(obs(spark, sf), -3 * 3600)


_STEPPED = "CASE WHEN value IS NOT NULL THEN floor(value / 40) END"


@query("win5_run_length", f"""WITH {OBS}, v AS (SELECT station, param, ts, seq, {_STEPPED} AS value FROM obs),
c AS (SELECT *, CASE WHEN row_number() OVER ({W}) = 1 OR value IS DISTINCT FROM lag(value) OVER ({W}) THEN 1 ELSE 0 END AS new FROM v),
g AS (SELECT *, sum(new) OVER ({W} {UP} CURRENT ROW) AS grp FROM c)
SELECT station, param, ts, seq, value, CASE WHEN value IS NOT NULL THEN count(*) OVER (PARTITION BY station, param, grp) END AS run_len FROM g""")
def _(spark, sf):
    d = obs(spark, sf).withColumn("value", F.floor(F.col("value") / 40).cast("double"))
    return WN.run_length(d, K, order=("ts", "seq"), seconds=width(spark, sf))


_GAPS = f"""WITH {HOURLY}, c AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR (value IS NULL) <> (lag(value) OVER ({WH}) IS NULL) THEN 1 ELSE 0 END AS new FROM hourly),
g AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM c),
l AS (SELECT station, param, ts, value, CASE WHEN value IS NULL THEN count(*) OVER (PARTITION BY station, param, grp) ELSE 0 END AS gap_len,
  CASE WHEN value IS NOT NULL THEN count(*) OVER (PARTITION BY station, param, grp) ELSE 0 END AS good_len FROM g)"""


@query("win6_gap_length", _GAPS + " SELECT station, param, ts, value, gap_len, good_len FROM l")
def _(spark, sf):
    return WN.gap_length(hourly(spark, sf), K, seconds=width(spark, sf))


_GOOD = _GAPS + f""", k AS (SELECT *, (value IS NOT NULL OR gap_len <= 2) AS ok FROM l),
k2 AS (SELECT *, CASE WHEN row_number() OVER ({WH}) = 1 OR ok <> lag(ok) OVER ({WH}) THEN 1 ELSE 0 END AS new FROM k),
k3 AS (SELECT *, sum(new) OVER ({WH} {UP} CURRENT ROW) AS grp FROM k2),
good AS (SELECT station, param, ts, value, CASE WHEN ok THEN count(*) OVER (PARTITION BY station, param, grp) ELSE 0 END AS good_run FROM k3)"""


@query("win7_fill_small_gaps", _GOOD + " SELECT station, param, ts, value, good_run FROM good")
def _(spark, sf):
    return WN.good_runs_over_small_gaps(hourly(spark, sf), K, 2, seconds=width(spark, sf))


for _align, _frame in (("center", "ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING"), ("trailing", "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"), ("leading", "ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING")):
    @query(f"win8_rolling_median_{_align}", f"WITH {OBS} SELECT station, param, ts, seq, value, round(median(value) OVER ({W} {_frame}), 6) AS median FROM obs")
    def _(spark, sf, align=_align):
        return WN.rolling_median(obs(spark, sf), K, 7, align, order=("ts", "seq"), seconds=width(spark, sf)).withColumn("median", r6(F.col("median")))


def _full(spark, sf):
    """Hourly series without gaps except one day per series."""
    v = F.when(F.dayofmonth("ts") != 15, F.coalesce("value", F.lit(20.0)))
    return hourly(spark, sf).withColumn("value", v)


_FULL = HOURLY + ", full_s AS (SELECT station, param, ts, CASE WHEN day(ts) <> 15 THEN coalesce(value, 20.0) END AS value FROM hourly)"
_LZ = f"""{_FULL}, tap AS (SELECT j, (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * 2 * j / 12.0) / (pi() * 2 * j / 12.0) END) * (CASE WHEN j = 0 THEN 1 ELSE sin(pi() * j / 19.0) / (pi() * j / 19.0) END) AS w0 FROM range(-18, 19) t(j)),
tapn AS (SELECT j, w0 / (SELECT sum(w0) FROM tap) AS w FROM tap),
f AS (SELECT a.station, a.param, a.ts, a.value, CASE WHEN count(b.value) = 37 THEN sum(b.value * w) END AS filtered
 FROM full_s a CROSS JOIN tapn LEFT JOIN full_s b ON b.station = a.station AND b.param = a.param AND b.ts = a.ts + to_hours(j) GROUP BY ALL)"""


@query("win9_lowpass", f"WITH {_LZ} SELECT station, param, ts, value, round(filtered, 6) AS filtered FROM f")
def _(spark, sf):
    return WN.lowpass(_full(spark, sf), K, 3600, 12 * 3600).withColumn("filtered", r6(F.col("filtered")))


@query("win10_gaussian", f"""WITH {_FULL}, tap AS (SELECT j, exp(-0.5 * (j / 2.0) * (j / 2.0)) AS w0 FROM range(-8, 9) t(j)),
tapn AS (SELECT j, w0 / (SELECT sum(w0) FROM tap) AS w FROM tap), lim AS (SELECT station, param, min(ts) AS a, max(ts) AS b FROM full_s GROUP BY ALL),
f AS (SELECT x.station, x.param, x.ts, x.value, CASE WHEN count(b.value) = 17 THEN sum(b.value * w) END AS filtered
 FROM full_s x JOIN lim USING (station, param) CROSS JOIN tapn LEFT JOIN full_s b ON b.station = x.station AND b.param = x.param AND b.ts = least(greatest(x.ts + to_hours(j), lim.a), lim.b) GROUP BY ALL)
SELECT station, param, ts, value, round(filtered, 6) AS filtered FROM f""")
def _(spark, sf):
    return WN.gaussian_smooth(_full(spark, sf), K, 3600, 2.0, seconds=width(spark, sf)).withColumn("filtered", r6(F.col("filtered")))


PUMPS = {"T/IS": 1, "I/S": 1, "I/P": 1, "S/D": 0, "SED": 0, "SO/S": 0, "FOG": 0}
_OPS = ["I/S", "S/D", "I/P,late", "T/S", "FOG"]


def pump_events(spark, sf):
    e = table(spark, sf, "events")
    status = F.element_at(F.array(*[F.lit(s) for s in _OPS]), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select(F.col("event_type").alias("station"), F.lit("plant").alias("param"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"),
                    (F.col("user_id") % 11).alias("unit"), status.alias("status"), F.when(F.col("user_id") % 11 < 2, 375.0).otherwise(1130.0).alias("capacity"), F.col("event_id").alias("seq"))


LEVEL = f"""pe AS (SELECT event_type AS station, 'plant' AS param, date_trunc('minute', ts) AS ts, user_id % 11 AS unit, event_id AS seq,
 CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 4 THEN 0 END AS state, CASE WHEN user_id % 11 < 2 THEN 375.0 ELSE 1130.0 END AS cap FROM events),
pu AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY station, unit ORDER BY ts, seq), 0) AS before FROM pe WHERE state IS NOT NULL),
pd AS (SELECT station, param, ts, CASE WHEN before = state THEN 0.0 WHEN state = 1 THEN cap ELSE -cap END AS delta FROM pu UNION ALL SELECT station, param, ts, 0.0 FROM pe WHERE state IS NULL),
pt AS (SELECT station, param, ts, CASE WHEN ts = min(ts) OVER (PARTITION BY station) THEN greatest(delta, 0.0) ELSE delta END AS delta FROM pd),
pa AS (SELECT station, param, ts, sum(delta) AS delta, max((delta <> 0)::INT) AS moved FROM pt GROUP BY ALL),
pl AS (SELECT station, param, ts, CAST(sum(delta) OVER (PARTITION BY station ORDER BY ts) AS DOUBLE) AS level, moved FROM pa)"""


@query("win11_cumulative_level", f"WITH {LEVEL} SELECT station, param, ts, level FROM pl WHERE moved = 1")
def _(spark, sf):
    return WN.cumulative_level(pump_events(spark, sf), K, status_map=PUMPS, tie="seq", seconds=width(spark, sf))


@query("win12_dst_ambiguity", f"""WITH {OBS}, m AS (SELECT station, param, date_trunc('hour', ts) - CASE WHEN seq % 4 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ts, seq, value FROM obs)
SELECT station, param, ts, first(value ORDER BY seq) AS value FROM m GROUP BY ALL""")
def _(spark, sf):
    d = obs(spark, sf).withColumn("tz", F.when(F.col("seq") % 4 == 0, "PDT").otherwise("PST")).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return WN.dst_to_standard(d, K)


@query("win13_subtidal_split", f"WITH {_LZ} SELECT station, param, ts, value, round(filtered, 6) AS subtidal, round(value - filtered, 6) AS tidal FROM f")
def _(spark, sf):
    s = WN.subtidal_split(_full(spark, sf), K, 3600, 12 * 3600)
    return s.withColumn("subtidal", r6(F.col("subtidal"))).withColumn("tidal", r6(F.col("tidal")))


@query("win14_active_ffill", f"WITH {HOURLY} SELECT station, param, ts, value, last_value(value > 60 IGNORE NULLS) OVER ({WH} {UP} CURRENT ROW) AS active FROM hourly")
def _(spark, sf):
    return WN.active_ffill(hourly(spark, sf), K, F.col("value") > 60, seconds=width(spark, sf))


# --- TIM ---------------------------------------------------------------------


@query("tim1_infer_freq", f"""WITH {HB}, x AS (SELECT station, param, ts FROM hb UNION ALL SELECT station, 'day', date_trunc('day', ts) FROM obs GROUP BY ALL),
s AS (SELECT station, param, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY station, param ORDER BY ts)) AS us FROM x),
c AS (SELECT station, param, us, count(*) AS n FROM s WHERE us IS NOT NULL GROUP BY ALL),
t AS (SELECT station, param, sum(n)::BIGINT AS steps, max(n) AS top, first(us ORDER BY n DESC, us) AS us FROM c GROUP BY ALL)
SELECT station, param, CASE WHEN top >= 0.9 * steps THEN us // 1000000 END AS freq, steps FROM t""")
def _(spark, sf):
    h = hourly_rows(spark, sf).select(*K, "ts")
    d = obs(spark, sf).select("station", F.lit("day").alias("param"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).distinct()
    return G.infer_freq(h.unionByName(d), K, seconds=width(spark, sf))


_REG = f"""{OBS}, i AS (SELECT station, param, value, epoch_us(ts) AS us, epoch_us(ts) // 1800000000 AS q, epoch_us(ts) % 1800000000 AS r FROM obs),
i2 AS (SELECT *, q + CASE WHEN r * 2 > 1800000000 OR (r * 2 = 1800000000 AND q % 2 = 1) THEN 1 ELSE 0 END AS idx FROM i),
b AS (SELECT station, param, idx, arg_min_null(value, ((value IS NULL)::INT * 1000000000000 + abs(us - idx * 1800000000)) * 10 + (us > idx * 1800000000)::INT) AS value FROM i2 GROUP BY ALL),
sp AS (SELECT station, param, min(idx) AS a, max(idx) AS z FROM b GROUP BY ALL), g AS (SELECT station, param, unnest(generate_series(a, z)) AS idx FROM sp),
reg AS (SELECT g.station, g.param, make_timestamp(g.idx * 1800000000) AS ts, b.value FROM g LEFT JOIN b USING (station, param, idx))"""


@query("tim2_regularize", f"WITH {_REG} SELECT station, param, ts, value FROM reg")
def _(spark, sf):
    return G.regularize(obs(spark, sf), K, 1800)


@query("tim3_asfreq", f"""WITH {OBS}, m AS (SELECT station, param, date_trunc('minute', ts) AS ts, max(value) AS value FROM obs GROUP BY ALL), s AS (SELECT station, param, min(ts) AS a, max(ts) AS b FROM m GROUP BY ALL),
g AS (SELECT station, param, unnest(generate_series(a, b, INTERVAL 5 MINUTE)) AS ts FROM s) SELECT g.station, g.param, g.ts, m.value FROM g LEFT JOIN m USING (station, param, ts)""")
def _(spark, sf):
    m = obs(spark, sf).groupBy(*K, F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("value"))
    return G.asfreq(m, K, 300)


@query("tim4_interp_to", f"""WITH {OBS}, v AS (SELECT station, param, epoch_us(ts) AS us, max(value) AS value FROM obs WHERE value IS NOT NULL GROUP BY ALL),
s AS (SELECT station, param, min(epoch_us(ts)) // 900000000 AS a, -((-max(epoch_us(ts))) // 900000000) AS b FROM obs GROUP BY ALL),
s2 AS (SELECT station, param, a, (SELECT max(x) FROM (VALUES (b)) t(x)) AS b FROM s),
g AS (SELECT station, param, unnest(generate_series(a, CASE WHEN b * 900000000 < mx THEN b + 1 ELSE b END)) * 900000000 AS us FROM s2 JOIN (SELECT station, param, max(epoch_us(ts)) AS mx FROM obs GROUP BY ALL) USING (station, param)),
u AS (SELECT station, param, us, max(value) AS value, max(g) AS g FROM (SELECT station, param, us, value, 0 AS g FROM v UNION ALL SELECT station, param, us, NULL, 1 FROM g) GROUP BY ALL),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY station, param ORDER BY us {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER (PARTITION BY station, param ORDER BY us {UP} 1 PRECEDING) AS ta,
 first_value(value IGNORE NULLS) OVER (PARTITION BY station, param ORDER BY us ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b,
 first_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER (PARTITION BY station, param ORDER BY us ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS tb FROM u)
SELECT station, param, make_timestamp(us) AS ts, round(coalesce(value, a + (b - a) * (us - ta) / (tb - ta), a), 6) AS value FROM f WHERE g = 1""")
def _(spark, sf):
    return G.interp_to(obs(spark, sf), K, 900, seconds=width(spark, sf)).withColumn("value", r6(F.col("value")))


_DEC = "dec AS (SELECT station, param, CAST(least(floor(median(length(rtrim(split_part(CAST(CAST(value AS DECIMAL(38, 10)) AS VARCHAR), '.', 2), '0')))), 4) AS INTEGER) AS d FROM obs WHERE value IS NOT NULL GROUP BY ALL)"


@query("tim4_interp_decimals", ORACLE["tim4_interp_to"].replace("SELECT station, param, make_timestamp(us) AS ts, round(coalesce(value, a + (b - a) * (us - ta) / (tb - ta), a), 6) AS value FROM f WHERE g = 1",
       f", {_DEC} SELECT station, param, make_timestamp(us) AS ts, round(coalesce(value, a + (b - a) * (us - ta) / (tb - ta), a) * power(10, d)) / power(10, d) AS value FROM f JOIN dec USING (station, param) WHERE g = 1"))
def _(spark, sf):
    o = obs(spark, sf)
    return G.interp_to(o, K, 900, A.series_decimals(o, K), seconds=width(spark, sf))


def two_steps(spark, sf):
    """Each series as an hourly part 0 and a two-hourly part 1."""
    h = hourly(spark, sf)
    return h.withColumn("part", F.lit(0)).unionByName(h.filter(F.hour("ts") % 2 == 0).withColumn("part", F.lit(1)))


@query("tim5_resolve_freq", f"""WITH {HOURLY}, p AS (SELECT *, 0 AS part FROM hourly UNION ALL SELECT *, 1 AS part FROM hourly WHERE hour(ts) % 2 = 0),
s AS (SELECT station, param, part, min(ts) AS a, max(ts) AS b FROM p GROUP BY ALL), g AS (SELECT station, param, part, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM s)
SELECT g.station, g.param, g.part, g.ts, p.value FROM g LEFT JOIN p USING (station, param, part, ts)""")
def _(spark, sf):
    p = two_steps(spark, sf)
    fr = G.infer_freq(p, [*K, "part"], seconds=width(spark, sf)).select(*K, "part", "freq")
    return G.resolve_freq(p, K, fr, "as_freq_finer", (3600,), seconds=width(spark, sf)).select(*K, "part", "ts", "value")


@query("tim5_freq_choice", f"""WITH {OBS} SELECT station, param, CAST(7200 AS BIGINT) AS freq, true AS mixed FROM obs GROUP BY ALL""")
def _(spark, sf):
    fr = G.infer_freq(two_steps(spark, sf), [*K, "part"], seconds=width(spark, sf)).select(*K, "part", "freq")
    return G.freq_choice(fr, K, "interp_to_latest")


@query("tim6_ingest_policy", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'asfreq:finer' WHEN 1 THEN 'interp:latest' WHEN 2 THEN 'interp:finer' WHEN 3 THEN 'asfreq:coarser' ELSE 'interp:latest' END AS policy FROM orders""")
def _(spark, sf):
    m = F.col("o_orderkey") % 5
    a = F.when(m == 0, 3600).when(m == 1, 600).when(m == 2, 3600).when(m == 3, 86400).otherwise(1200)
    b = F.when(m == 0, 360).when(m == 3, 3600).otherwise(900)
    return table(spark, sf, "orders").select("o_orderkey", G.ingest_policy_column(a, b).alias("policy"))


@query("tim7_resample_interp", f"""WITH {HOURLY}, g AS (SELECT station, param, unnest(generate_series(min(ts), max(ts), INTERVAL 30 MINUTE)) AS ts FROM hourly GROUP BY station, param),
x AS (SELECT g.station, g.param, g.ts, h.value, row_number() OVER (PARTITION BY station, param ORDER BY ts) AS pos FROM g LEFT JOIN hourly h USING (station, param, ts)),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS pa,
 first_value(value IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pb FROM x)
SELECT station, param, ts, value, round(coalesce(value, CASE WHEN pos - pa <= 3 THEN coalesce(a + (b - a) * (pos - pa) / (pb - pa), a) END), 6) AS filled FROM f""")
def _(spark, sf):
    return G.resample_interp(hourly(spark, sf), K, 1800, 3, seconds=width(spark, sf)).withColumn("filled", r6(F.col("filled")))


DISAGG = """s AS (SELECT station, param, ts, value AS a, lag(value) OVER w AS p, lag(ts) OVER w AS tp, lead(value) OVER w AS q, lead(ts) OVER w AS tq FROM daily WINDOW w AS (PARTITION BY station, param ORDER BY ts)),
e AS (SELECT *, coalesce(CASE WHEN ts - tp = INTERVAL 1 DAY THEN (p + a) / 2 END, a) AS l0, coalesce(CASE WHEN tq - ts = INTERVAL 1 DAY THEN (q + a) / 2 END, a) AS r0 FROM s),
m AS (SELECT *, (r0 - a) * (a - l0) <= 0 AS flat, (r0 - l0) * 6 * (a - (l0 + r0) / 2) AS wb, (r0 - l0) * (r0 - l0) AS ww FROM e),
n AS (SELECT *, CASE WHEN flat THEN a WHEN wb > ww THEN 3 * a - 2 * r0 ELSE l0 END AS l, CASE WHEN flat THEN a WHEN wb < -ww THEN 3 * a - 2 * l0 ELSE r0 END AS r FROM m),
o AS (SELECT *, 6 * (a - (l + r) / 2) AS c FROM n),
fine AS (SELECT station, param, ts + to_seconds(9600 * j) AS ts, ((l * x1 + (r - l) * x1 * x1 / 2 + c * (x1 * x1 / 2 - x1 * x1 * x1 / 3)) - (l * x0 + (r - l) * x0 * x0 / 2 + c * (x0 * x0 / 2 - x0 * x0 * x0 / 3))) * 9 AS value
 FROM (SELECT o.*, j, j / 9.0::DOUBLE AS x0, (j + 1) / 9.0::DOUBLE AS x1 FROM o, range(9) t(j)))"""


@query("tim8_disaggregate", f"WITH {DAILY}, {DISAGG} SELECT station, param, ts, round(value, 5) AS value FROM fine")
def _(spark, sf):
    return G.disaggregate(daily(spark, sf), K, 86400, 9600).withColumn("value", F.round("value", 5))


@query("tim9_coarsen", f"""WITH RECURSIVE {OBS}, c AS (SELECT station, param, date_trunc('hour', ts) AS ts, last(value ORDER BY ts) AS v FROM obs WHERE value IS NOT NULL GROUP BY station, param, date_trunc('hour', ts)),
r AS (SELECT station, param, ts, row_number() OVER (PARTITION BY station, param ORDER BY ts) AS n, CASE WHEN v = 0 THEN v ELSE round_even(v / 5.0::DOUBLE, 0) * 5.0::DOUBLE END AS q FROM c),
w AS (SELECT station, param, n, ts, q, ts AS lt, q AS lv, true AS e FROM r WHERE n = 1
 UNION ALL SELECT station, param, n, ts, q, CASE WHEN e THEN ts ELSE lt END, CASE WHEN e THEN q ELSE lv END, e FROM (
  SELECT r.*, lt, lv, abs(r.q - lv) > 5 OR (r.q = 0) <> (lv = 0) OR r.ts - lt >= INTERVAL 6 HOUR AS e FROM w JOIN r ON r.station = w.station AND r.param = w.param AND r.n = w.n + 1))
SELECT station, param, ts, q AS value FROM w WHERE e""")
def _(spark, sf):
    return G.coarsen(obs(spark, sf), K, 3600, 5.0, 1.0, 6 * 3600, (0.0,), seconds=width(spark, sf))


@query("tim9_last_per_cell", f"WITH {OBS} SELECT station, param, date_trunc('hour', ts) AS ts, last(value ORDER BY ts) AS value FROM obs WHERE value IS NOT NULL GROUP BY station, param, date_trunc('hour', ts)")
def _(spark, sf):
    return G.last_per_cell(obs(spark, sf), K, 3600)


@query("tim10_local_to_fixed", """WITH l AS (SELECT event_type AS station, 'p' AS param, ts + INTERVAL 299 DAY AS ts, event_id AS seq, value FROM events),
z AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-11-03 01:00:00' THEN ts - INTERVAL 1 HOUR ELSE ts END AS t FROM l)
SELECT station, param, date_trunc('minute', t) AS ts, first(value ORDER BY seq) AS value FROM z GROUP BY station, param, date_trunc('minute', t)""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("station"), F.lit("p").alias("param"), (F.col("ts") + F.expr("INTERVAL 299 DAYS")).alias("ts"),
                                          F.col("event_id").alias("seq"), "value")
    return G.local_to_fixed(e, K)


@query("tim11_year_blocks", "SELECT o_orderkey, CAST(year(o_orderdate) // 5 * 5 AS INTEGER) AS block FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", G.year_block(F.year("o_orderdate"), 5).alias("block"))


@query("tim12_compare_freq", """WITH k AS (SELECT DISTINCT event_type AS station, user_id % 3 AS m FROM events)
SELECT station, 'p' || m AS param, CASE WHEN m = 0 THEN 'both_regular_same' WHEN m = 1 THEN 'dst_irregular' ELSE 'both_regular_different' END AS freq_class FROM k""")
def _(spark, sf):
    h = hourly(spark, sf)
    raw = obs(spark, sf).select(*K, "ts", "value")
    other = h.filter("param = 'p0'").unionByName(raw.filter("param = 'p1'")).unionByName(h.filter((F.col("param") == "p2") & (F.hour("ts") % 3 == 0)))
    s = width(spark, sf)
    return G.compare_freq(G.infer_freq(h, K, seconds=s), G.infer_freq(other, K, seconds=s), K).select(*K, "freq_class")


@query("tim13_floor_to_cycle", "SELECT event_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS cycle, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS next_cycle FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", G.floor_to_cycle("ts", 6).alias("cycle"), G.floor_to_cycle("ts", 6, "ceil").alias("next_cycle"))
