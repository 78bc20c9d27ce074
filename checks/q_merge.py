"""MRG, SET, JOIN-8..13, AGG-6..11, CFG-1 queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import DAILY, HB, HOURLY, K, OBS, UP, WH, daily, hourly, hourly_rows, obs, query, r6, table, width
from tidewell.operators import aggs as A, align as AL, merge as M, request as RQ, spatial as SP
from tidewell.plans import catalog as C, series as SE
from tidewell.schema import ntz


def providers(spark, sf):
    """Three providers of each series: a ends early, b starts later and ends, c has the rest."""
    o, ts, third = obs(spark, sf), F.col("ts"), F.col("seq") % 3
    p = F.when((third == 0) & (ts < ntz("2024-01-12 00:00:00")), 0).when((third == 1) & (ts >= ntz("2024-01-06 00:00:00")) & (ts < ntz("2024-01-20 00:00:00")), 1).otherwise(2)
    m = o.groupBy(*K, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), p.alias("p")).agg(F.max("value").alias("value"))
    return [m.filter(F.col("p") == i).drop("p") for i in range(3)]


PROV = OBS + """, pv AS (SELECT station, param, date_trunc('hour', ts) AS ts, CASE WHEN seq % 3 = 0 AND ts < TIMESTAMP '2024-01-12' THEN 0
 WHEN seq % 3 = 1 AND ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS p, max(value) AS value FROM obs GROUP BY ALL)"""
_MERGED = "SELECT station, param, ts, first(value ORDER BY p) FILTER (value IS NOT NULL) AS value FROM pv GROUP BY ALL"


@query("mrg1_ts_merge", f"WITH {PROV} {_MERGED}")
def _(spark, sf):
    return M.ts_merge(providers(spark, sf), K)


@query("mrg2_ts_merge_strict", f"""WITH {PROV}, sp AS (SELECT station, param, p, min(ts) AS a, max(ts) AS b FROM pv WHERE value IS NOT NULL GROUP BY ALL),
k AS (SELECT * FROM pv WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.station = pv.station AND sp.param = pv.param AND sp.p < pv.p AND pv.ts BETWEEN sp.a AND sp.b))
SELECT station, param, ts, first(value ORDER BY p) FILTER (value IS NOT NULL) AS value FROM k GROUP BY ALL""")
def _(spark, sf):
    return M.ts_merge(providers(spark, sf), K, strict_priority=True, seconds=width(spark, sf))


_ENDS = """, e AS (SELECT station, param, min(ts) FILTER (p = 0 AND value IS NOT NULL) AS s0, min(ts) FILTER (p = 1 AND value IS NOT NULL) AS s1, min(ts) FILTER (p = 2 AND value IS NOT NULL) AS s2,
 max(ts) FILTER (p = 0 AND value IS NOT NULL) AS e0, max(ts) FILTER (p = 1 AND value IS NOT NULL) AS e1 FROM pv GROUP BY ALL)"""
_FIRST = _ENDS + """, spl AS (SELECT pv.* FROM pv JOIN e USING (station, param) WHERE (p = 0 AND ts <= e0) OR (p = 1 AND ts > e0 AND ts <= greatest(e0, e1)) OR (p = 2 AND ts > greatest(e0, e1)))"""


@query("mrg3_splice_first", f"WITH {PROV} {_FIRST} SELECT station, param, ts, value FROM spl")
def _(spark, sf):
    return M.ts_splice(providers(spark, sf), K, "first", seconds=width(spark, sf))


@query("mrg4_splice_last", f"WITH {PROV} {_ENDS} SELECT pv.station, pv.param, ts, value FROM pv JOIN e USING (station, param) WHERE (p = 0 AND ts < least(s1, s2)) OR (p = 1 AND ts >= least(s1, s2) AND ts < s2) OR (p = 2 AND ts >= s2)")
def _(spark, sf):
    return M.ts_splice(providers(spark, sf), K, "last", seconds=width(spark, sf))


def sharded(spark, sf):
    d = daily(spark, sf)
    return d.withColumn("shard", F.year("ts").cast("string"))


@query("mrg5_merge_shards", f"WITH {DAILY} SELECT station, param, ts, value FROM daily")
def _(spark, sf):
    return M.merge_shards(sharded(spark, sf), K)


@query("mrg5_shard_overlaps", f"""WITH {DAILY}, s AS (SELECT station, param, CASE WHEN ts < TIMESTAMP '1997-02-01' AND day(ts) % 2 = 0 THEN '1996' ELSE CAST(year(ts) AS VARCHAR) END AS shard, ts FROM daily),
p AS (SELECT station, param, shard, min(ts) AS a, max(ts) AS b FROM s GROUP BY ALL),
l AS (SELECT station, param, shard AS shard_a, b AS "end", lead(shard) OVER (PARTITION BY station ORDER BY a, shard) AS shard_b, lead(a) OVER (PARTITION BY station ORDER BY a, shard) AS next_start FROM p)
SELECT * FROM l WHERE next_start <= "end" """)
def _(spark, sf):
    d = sharded(spark, sf)
    return M.shard_overlaps(d.withColumn("shard", F.when((F.col("ts") < ntz("1997-02-01 00:00:00")) & (F.dayofmonth("ts") % 2 == 0), "1996").otherwise(F.col("shard"))), K)


_NAMES = ["ncro", "cdec", "usgs"]


def provider_obs(spark, sf):
    out = None
    for i, p in enumerate(providers(spark, sf)):
        d = p.withColumn("provider", F.lit(_NAMES[i])).withColumn("shard", F.weekofyear("ts").cast("string"))
        out = d if out is None else out.unionByName(d)
    return out


def order_of(spark, sf):
    reg = table(spark, sf, "events").select(F.col("event_type").alias("station")).distinct().withColumn("agency", F.lit("ncro"))
    return C.provider_order(provider_obs(spark, sf), reg, C.priority_table(spark, {"ncro": _NAMES}))


@query("mrg6_read_series", f"WITH {PROV} {_FIRST} SELECT station, param, ts, value FROM spl WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25'")
def _(spark, sf):
    return SE.read_series(provider_obs(spark, sf), K, order_of(spark, sf), 3, "2024-01-03 00:00:00", "2024-01-25 00:00:00", seconds=width(spark, sf))


@query("mrg7_read_series_multi", f"WITH {PROV}, t AS (SELECT station, param, ts, p, CASE p WHEN 2 THEN value * 2 WHEN 1 THEN round(value) ELSE value END AS value FROM pv) SELECT station, param, ts, first(value ORDER BY p) FILTER (value IS NOT NULL) AS value FROM t GROUP BY ALL")
def _(spark, sf):
    return SE.read_series_multi(provider_obs(spark, sf), K, [
        (F.col("provider") == "ncro", None), (F.col("provider") == "cdec", lambda d: d.withColumn("value", F.round("value"))), (F.col("provider") == "usgs", lambda d: d.withColumn("value", F.col("value") * 2))])


@query("mrg8_latest_wins", f"WITH {PROV} SELECT station, param, ts, arg_max_null(value, p) AS value FROM pv WHERE p < 2 GROUP BY ALL")
def _(spark, sf):
    a, b, _ = providers(spark, sf)
    return M.latest_wins(a, b, K)


for _keep, _fn in (("first", "arg_min_null"), ("last", "arg_max_null")):
    @query(f"mrg9_dedupe_{_keep}", f"WITH {OBS} SELECT station, param, date_trunc('hour', ts) AS ts, {_fn}(value, seq) AS value FROM obs GROUP BY ALL")
    def _(spark, sf, keep=_keep):
        return M.dedupe(obs(spark, sf).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")), K, "seq", keep)


@query("mrg10_overlay", f"WITH {PROV} SELECT a.station, a.param, a.ts, coalesce(b.value, a.value) AS value FROM pv a LEFT JOIN (SELECT * FROM pv WHERE p = 1) b USING (station, param, ts) WHERE a.p = 0")
def _(spark, sf):
    a, b, _ = providers(spark, sf)
    return M.overlay(a, b, K)


@query("mrg11_fill_from", """SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_tax > 0.04 THEN l_tax END, CASE WHEN l_discount > 0.05 THEN l_discount END, l_quantity) AS value FROM lineitem""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", M.fill_from(F.when(F.col("l_tax") > 0.04, F.col("l_tax")), F.when(F.col("l_discount") > 0.05, F.col("l_discount")), F.col("l_quantity")).alias("value"))


@query("mrg12_ts_blend", f"""WITH {PROV}, x AS (SELECT station, param, ts, max(value) FILTER (p = 0) AS p, max(value) FILTER (p = 2) AS s FROM pv WHERE p <> 1 GROUP BY ALL),
f AS (SELECT *, last_value(CASE WHEN p IS NOT NULL THEN {{'d': p - s, 't': epoch_us(ts)}} END IGNORE NULLS) OVER ({WH} {UP} 1 PRECEDING) AS a,
 first_value(CASE WHEN p IS NOT NULL THEN {{'d': p - s, 't': epoch_us(ts)}} END IGNORE NULLS) OVER ({WH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b, epoch_us(ts) AS t FROM x),
g AS (SELECT *, least(6 * 3600000000, coalesce(b.t - a.t, 6 * 3600000000)) AS len FROM f)
SELECT station, param, ts, round(coalesce(p, s + coalesce(greatest(1 - (t - a.t) / len, 0.0) * a.d, 0) + coalesce(greatest(1 - (b.t - t) / len, 0.0) * b.d, 0)), 6) AS value FROM g""")
def _(spark, sf):
    a, _, c = providers(spark, sf)
    return M.ts_blend(a, c, K, 6 * 3600, seconds=width(spark, sf)).withColumn("value", r6(F.col("value")))


def slice_rules(spark, sf):
    """One rule per year file of each series; 1998 is left out."""
    y = daily(spark, sf).select(*K, F.year("ts").alias("y")).distinct()
    f = lambda c: F.concat(F.lit("f_"), c.cast("string"))
    return y.select(*K, f(F.col("y")).alias("file"), (F.col("y") != 1998).alias("include"), F.to_timestamp_ntz(F.concat(F.col("y").cast("string"), F.lit("-02-15"))).alias("start"),
                    F.col("y").alias("ord"), F.concat(F.lit("out_"), F.col("y").cast("string")).alias("target"))


@query("mrg13_partition_slices", f"""WITH {DAILY}, r AS (SELECT DISTINCT station, param, year(ts) AS y FROM daily WHERE year(ts) <> 1998),
s AS (SELECT *, make_timestamp(y, 2, 15, 0, 0, 0) AS a, lead(make_timestamp(y, 2, 15, 0, 0, 0)) OVER (PARTITION BY station ORDER BY y) AS b FROM r)
SELECT d.station, d.param, ts, value, 'f_' || y AS file, 'out_' || y AS target FROM daily d JOIN s ON s.station = d.station AND s.y = year(d.ts) WHERE ts >= a AND (b IS NULL OR ts < b)""")
def _(spark, sf):
    d = daily(spark, sf).withColumn("file", F.concat(F.lit("f_"), F.year("ts").cast("string")))
    return M.partition_slices(d, slice_rules(spark, sf), K)


@query("mrg13_check_slices", f"""WITH {DAILY}, y AS (SELECT DISTINCT station, param, year(ts) AS y FROM daily)
SELECT station, param, 'f_' || y AS file, 'not_covered' AS problem FROM y WHERE y = 1999 UNION ALL
SELECT station, param, 'f_' || y, 'empty_slice' FROM y WHERE y = 1996""")
def _(spark, sf):
    r = slice_rules(spark, sf)
    late = F.when(F.col("ord") == 1996, F.to_timestamp_ntz(F.lit("1998-01-01"))).otherwise(F.col("start"))
    return M.check_slices(r.filter("ord != 1999").withColumn("start", late).withColumn("include", F.col("ord") != 1998), r, K)


@query("mrg14_merge_files", f"WITH {PROV} {_MERGED}")
def _(spark, sf):
    return M.merge_files("merge", providers(spark, sf)[::-1], K, "last")


@query("cfg1_provider_order", f"WITH k AS (SELECT DISTINCT event_type AS station FROM events) SELECT station, p AS provider, CAST(i AS INTEGER) AS prio FROM k, (VALUES ('ncro', 0), ('cdec', 1), ('usgs', 2)) t(p, i)")
def _(spark, sf):
    return order_of(spark, sf)


# --- SET ---------------------------------------------------------------------


@query("set1_concat", f"WITH {PROV} SELECT station, param, ts, value FROM pv")
def _(spark, sf):
    return M.concat(*providers(spark, sf))


def _catalogs(spark, sf):
    o = table(spark, sf, "orders")
    nm = lambda y: F.concat(F.lit("usgs_"), (F.col("o_custkey") % 200).cast("string"), F.lit("_flow_"), y.cast("string"), F.lit(".csv"))
    base = o.select(nm(F.year("o_orderdate")).alias("file")).distinct()
    comp = o.filter(F.month("o_orderdate") > 6).select(nm(F.year("o_orderdate") + F.when(F.col("o_custkey") % 5 == 0, 3).otherwise(0)).alias("file")).distinct()
    return base, comp


@query("set2_compare_catalogs", """WITH b AS (SELECT DISTINCT 'usgs_' || (o_custkey % 200) || '_flow_' || year(o_orderdate) || '.csv' AS f FROM orders),
c AS (SELECT DISTINCT 'usgs_' || (o_custkey % 200) || '_flow_' || (year(o_orderdate) + CASE WHEN o_custkey % 5 = 0 THEN 3 ELSE 0 END) || '.csv' AS f FROM orders WHERE month(o_orderdate) > 6),
ob AS (SELECT f, left(f, length(f) - 8) AS k FROM b WHERE f NOT IN (SELECT f FROM c)), oc AS (SELECT f, left(f, length(f) - 8) AS k FROM c WHERE f NOT IN (SELECT f FROM b))
SELECT f AS name, f AS other, 'same' AS match FROM b WHERE f IN (SELECT f FROM c)
UNION ALL SELECT f, (SELECT max(oc.f) FROM oc WHERE oc.k = ob.k), 'near' FROM ob WHERE k IN (SELECT k FROM oc)
UNION ALL SELECT f, NULL, 'base_only' FROM ob WHERE k NOT IN (SELECT k FROM oc) AND NOT regexp_matches(f, '_19[0-9]_')
UNION ALL SELECT f, NULL, 'comp_only' FROM oc WHERE k NOT IN (SELECT k FROM ob)""")
def _(spark, sf):
    return M.compare_catalogs(*_catalogs(spark, sf), two_year=True, exceptions={"base": ["_19[0-9]_"]})


@query("set3_index_difference", f"WITH {PROV}, t AS (SELECT station, param, ts, max((p = 0)::INT) AS s, max((p = 2)::INT) AS r FROM pv WHERE p <> 1 GROUP BY ALL) SELECT station, param, count(*) FILTER (s = 1 AND r = 1) AS common, count(*) FILTER (r = 0) AS staged_only, count(*) FILTER (s = 0) AS repo_only FROM t GROUP BY ALL")
def _(spark, sf):
    a, _, c = providers(spark, sf)
    return M.index_difference(a, c, K)


# --- JOIN-8..13 --------------------------------------------------------------


def regions(spark):
    """Two polygons in the plane of (quantity, price / 1000)."""
    rows = [("delta", [(5.0, 10.0), (30.0, 5.0), (40.0, 40.0), (10.0, 50.0)]), ("bay", [(20.0, 60.0), (45.0, 60.0), (32.0, 90.0)])]
    return spark.createDataFrame(rows, "region string, ring array<struct<x: double, y: double>>")


def _inside_sql(points):
    n = len(points)
    parts = []
    for i in range(n):
        (ax, ay), (bx, by) = points[i], points[(i + 1) % n]
        parts.append(f"(({ay}::DOUBLE > y) <> ({by}::DOUBLE > y) AND x < ({bx}::DOUBLE - {ax}) * (y - {ay}) / NULLIF({by}::DOUBLE - {ay}, 0) + {ax})::INT")
    return "coalesce((" + " + ".join(f"coalesce({p}, 0)" for p in parts) + ") % 2 = 1, false)"


@query("join8_region_join", f"""WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS station_id, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY l_partkey, l_suppkey) = 1)
SELECT station_id, x, y, CASE WHEN {_inside_sql([(20, 60), (45, 60), (32, 90)])} THEN 'bay' WHEN {_inside_sql([(5, 10), (30, 5), (40, 40), (10, 50)])} THEN 'delta' ELSE 'default' END AS region FROM p""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    first = li.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("station_id")).agg(
        F.min_by(F.struct(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y")), F.struct("l_partkey", "l_suppkey")).alias("p"))
    return SP.region_join(first.select("station_id", "p.*"), regions(spark), cell=5.0)


@query("join9_align_outer", f"WITH {PROV} SELECT station, param, ts, max(value) FILTER (p = 0) AS a, max(value) FILTER (p = 1) AS b, max(value) FILTER (p = 2) AS c FROM pv GROUP BY ALL")
def _(spark, sf):
    return AL.align_outer(dict(zip("abc", providers(spark, sf))), K)


@query("join10_series_arith", f"WITH {PROV} SELECT a.station, a.param, a.ts, round(a.value - c.value, 6) AS value FROM pv a JOIN pv c USING (station, param, ts) WHERE a.p = 0 AND c.p = 2")
def _(spark, sf):
    a, _, c = providers(spark, sf)
    return AL.series_arith(a, c, "-", K).withColumn("value", r6(F.col("value")))


@query("join11_superseded", """WITH f AS (SELECT o_custkey % 50 AS series, 'f_' || o_custkey AS file, CAST(year(min(o_orderdate)) AS INTEGER) AS syear, CAST(year(max(o_orderdate)) AS INTEGER) AS eyear FROM orders GROUP BY o_custkey)
SELECT series, file, syear, eyear FROM f a WHERE EXISTS (SELECT 1 FROM f b WHERE b.series = a.series AND b.file <> a.file AND b.syear <= a.syear AND b.eyear >= a.eyear
 AND (b.syear < a.syear OR b.eyear > a.eyear OR b.file > a.file))""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    f = o.groupBy("o_custkey").agg(F.year(F.min("o_orderdate")).alias("syear"), F.year(F.max("o_orderdate")).alias("eyear"))
    f = f.select((F.col("o_custkey") % 50).alias("series"), F.concat(F.lit("f_"), F.col("o_custkey").cast("string")).alias("file"), "syear", "eyear")
    return RQ.superseded(f, ["series"])


@query("join12_reindex_like", f"WITH {PROV} SELECT c.station, c.param, c.ts, a.value FROM pv c LEFT JOIN (SELECT * FROM pv WHERE p = 0) a USING (station, param, ts) WHERE c.p = 2")
def _(spark, sf):
    a, _, c = providers(spark, sf)
    return AL.reindex_like(a, c, K)


@query("join13_value_asof", f"""WITH {HB}, o AS (SELECT station, param, ts + INTERVAL 7 MINUTE AS ts, value FROM hb), lim AS (SELECT station, param, time_bucket(INTERVAL 15 MINUTE, min(ts) + INTERVAL 899 SECOND, TIMESTAMP '1970-01-01') AS a, time_bucket(INTERVAL 15 MINUTE, max(ts), TIMESTAMP '1970-01-01') AS b FROM o GROUP BY ALL),
g AS (SELECT station, param, unnest(generate_series(a, b, INTERVAL 15 MINUTE)) AS ts FROM lim)
SELECT g.station, g.param, g.ts, v.value FROM g ASOF LEFT JOIN (SELECT * FROM o WHERE value IS NOT NULL) v ON g.station = v.station AND g.param = v.param AND g.ts >= v.ts""")
def _(spark, sf):
    d = hourly_rows(spark, sf).withColumn("ts", F.col("ts") + F.expr("INTERVAL 7 MINUTES"))
    return AL.value_asof(d, K, 900, seconds=width(spark, sf))


# --- AGG-6..11 ---------------------------------------------------------------


@query("agg6_replicate_counts", """WITH n AS (SELECT o_orderpriority AS station, o_orderstatus AS analyte, CASE WHEN o_orderstatus = 'P' THEN 'one' ELSE CAST(o_custkey % 4 AS VARCHAR) END AS subloc FROM orders),
c AS (SELECT station, analyte, subloc, count(*) AS n_sub FROM n GROUP BY ALL), t AS (SELECT *, CAST(sum(n_sub) OVER (PARTITION BY station, analyte) AS BIGINT) AS n_key FROM c)
SELECT *, CASE WHEN n_key = n_sub THEN 'default' ELSE subloc END AS label FROM t""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("station"), F.col("o_orderstatus").alias("analyte"),
                                          F.when(F.col("o_orderstatus") == "P", "one").otherwise((F.col("o_custkey") % 4).cast("string")).alias("subloc"))
    return A.replicate_counts(o, ["station", "analyte"])


@query("agg7_group_shards", """WITH f AS (SELECT DISTINCT 'usgs' AS source, 's' || (o_custkey % 100) AS station_id, 'default' AS subloc, 'flow' AS param, 'usgs_s' || (o_custkey % 100) || '_' || year(o_orderdate) || '.csv' AS file FROM orders)
SELECT source, station_id, subloc, param, count(*) AS files, min(file) AS first_file, max(file) AS last_file FROM f GROUP BY ALL""")
def _(spark, sf):
    st = F.concat(F.lit("s"), (F.col("o_custkey") % 100).cast("string"))
    f = table(spark, sf, "orders").select(F.lit("usgs").alias("source"), st.alias("station_id"), F.lit("default").alias("subloc"), F.lit("flow").alias("param"),
                                          F.concat(F.lit("usgs_"), st, F.lit("_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("file")).distinct()
    return A.group_shards(f)


@query("agg8_lag_correlation", f"""WITH {HOURLY}, y AS (SELECT station, param, ts + INTERVAL 3 HOUR AS ts, CASE WHEN hour(ts) % 5 <> 0 THEN value * 2 + hour(ts) END AS value FROM hourly),
c AS (SELECT x.station, x.param, CAST(l.l AS INTEGER) AS lag, corr(x.value, y.value) AS corr FROM hourly x CROSS JOIN range(-5, 6) l(l) JOIN y ON y.station = x.station AND y.param = x.param AND y.ts = x.ts + to_hours(l.l) WHERE x.value IS NOT NULL AND y.value IS NOT NULL GROUP BY ALL)
SELECT station, param, arg_max(lag, corr) AS lag, round(max(corr), 6) AS corr FROM c GROUP BY ALL""")
def _(spark, sf):
    x = hourly(spark, sf)
    y = x.select(*K, (F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("ts"), F.when(F.hour("ts") % 5 != 0, F.col("value") * 2 + F.hour("ts")).alias("value"))
    return A.lag_correlation(x, y, K, 5, 3600).withColumn("corr", r6(F.col("corr")))


@query("agg9_ols_fit", """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY ALL""")
def _(spark, sf):
    f = A.ols_fit(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity", F.col("l_shipdate") >= ntz("1997-01-01 00:00:00"))
    return f.withColumn("slope", r6(F.col("slope"))).withColumn("intercept", F.round("intercept", 4))


@query("agg10_series_decimals", f"WITH {OBS}, d AS (SELECT station, param, length(rtrim(split_part(CAST(CAST(value AS DECIMAL(38, 10)) AS VARCHAR), '.', 2), '0')) AS d FROM obs WHERE value IS NOT NULL) SELECT station, param, CAST(least(floor(median(d)), 4) AS INTEGER) AS decimals FROM d GROUP BY ALL")
def _(spark, sf):
    return A.series_decimals(obs(spark, sf), K)


@query("agg11_outcome_summary", """WITH a AS (SELECT 's' || o_custkey AS station, 'default' AS subloc, o_orderpriority AS param, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'found' WHEN o_orderstatus = 'O' THEN 'skipped' ELSE 'failed' END AS outcome,
 CASE o_orderkey % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'H' ELSE 'D' END AS duration, CAST(o_orderkey % 7 AS VARCHAR) AS code FROM orders)
SELECT station, subloc, param, CASE WHEN bool_or(outcome = 'found') THEN 'success' WHEN bool_and(outcome = 'skipped') THEN 'skipped' ELSE 'failed' END AS result,
 CASE WHEN bool_or(outcome = 'found') THEN string_agg(DISTINCT code, ',' ORDER BY code) FILTER (outcome = 'found') ELSE string_agg(DISTINCT code, ',' ORDER BY code) END AS codes, string_agg(DISTINCT duration, ',' ORDER BY duration) AS durations FROM a GROUP BY station, subloc, param""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    outcome = F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000), "found").when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed")
    m = F.col("o_orderkey") % 3
    a = o.select(F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("station"), F.lit("default").alias("subloc"), F.col("o_orderpriority").alias("param"),
                 outcome.alias("outcome"), F.when(m == 0, "E").when(m == 1, "H").otherwise("D").alias("duration"), (F.col("o_orderkey") % 7).cast("string").alias("code"))
    return A.outcome_summary(a).withColumn("codes", F.array_join("codes", ",")).withColumn("durations", F.array_join("durations", ","))
