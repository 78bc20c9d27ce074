"""REC and STR queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import K, query, table
from tidewell.operators import reconcile as R
from tidewell.operators.checks import split
from tidewell.operators.grid import asfreq
from tidewell.session import scratch, stage
from tidewell.streaming.topoff import read_repository, stream_topoff

YEAR = 2002


def sides(spark, sf):
    """Orders as daily series in year shards.  Repository: all but the last
    months of 2000 and the year 2001.  Staged: all but 1995; values of May in odd
    years and of 1997 changed for two priorities."""
    o = table(spark, sf, "orders")
    d = o.groupBy(F.col("o_orderpriority").alias("station"), F.lit("price").alias("param"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))
    d = asfreq(d, K, 86400).na.fill(0.0, ["value"])
    d = d.withColumn("shard", F.year("ts").cast("string"))
    y, m = F.year("ts"), F.month("ts")
    repo = d.filter((y != 2001) & ~((y == 2000) & (m > 9)))
    changed = (F.col("station").isin("1-URGENT", "5-LOW") & (y == 1997) & (m == 3)) | ((F.col("station") == "2-HIGH") & (y == 1999) & (m == 5))
    staged = d.filter((y != 1995) & ~((F.col("station") == "3-MEDIUM") & (y == 1998) & (m < 3))).withColumn("value", F.when(changed, F.col("value") + 1).otherwise(F.col("value")))
    cols = [*K, "shard", "ts", "value"]
    return staged.select(*cols), repo.select(*cols)


SIDES = """d0 AS (SELECT o_orderpriority AS station, 'price' AS param, o_orderdate AS ts, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL),
dg AS (SELECT station, param, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM d0 GROUP BY station, param),
d AS (SELECT station, param, ts, coalesce(value, 0) AS value, CAST(year(ts) AS VARCHAR) AS shard FROM dg LEFT JOIN d0 USING (station, param, ts)),
repo AS (SELECT * FROM d WHERE year(ts) <> 2001 AND NOT (year(ts) = 2000 AND month(ts) > 9)),
staged AS (SELECT station, param, ts, shard, CASE WHEN (station IN ('1-URGENT', '5-LOW') AND year(ts) = 1997 AND month(ts) = 3) OR (station = '2-HIGH' AND year(ts) = 1999 AND month(ts) = 5) THEN value + 1 ELSE value END AS value
 FROM d WHERE year(ts) <> 1995 AND NOT (station = '3-MEDIUM' AND year(ts) = 1998 AND month(ts) < 3)),
j AS (SELECT coalesce(s.station, r.station) AS station, coalesce(s.param, r.param) AS param, coalesce(s.shard, r.shard) AS shard, coalesce(s.ts, r.ts) AS ts, s.value AS sv, r.value AS rv, s.ts AS sts, r.ts AS rts FROM staged s FULL JOIN repo r USING (station, param, shard, ts)),
f AS (SELECT station, param, shard, count(sts) AS ns, count(rts) AS nr, count(*) FILTER (sts IS NOT NULL AND rts IS NOT NULL) AS common, count(*) FILTER (rts IS NULL) AS es, count(*) FILTER (sts IS NULL) AS er,
  count(*) FILTER (sts IS NOT NULL AND rts IS NOT NULL AND sv IS DISTINCT FROM rv) AS changed, min(ts) FILTER (rts IS NULL) AS es0, max(ts) FILTER (rts IS NULL) AS es1, min(rts) AS r0, max(rts) AS r1 FROM j GROUP BY ALL),
plan AS (SELECT station, param, shard, CASE WHEN nr = 0 THEN 'write' ELSE 'splice_write' END AS action, CASE WHEN nr = 0 THEN 'missing_in_repo' WHEN common = 0 THEN 'empty_overlap'
  WHEN es > 0 AND er = 0 AND es0 > r1 THEN 'append_only' WHEN es > 0 AND er = 0 AND es1 < r0 THEN 'prepend_only' WHEN es > 0 OR er > 0 THEN 'index_mismatch' ELSE 'overlap_values_changed' END AS reason
 FROM f WHERE ns > 0 AND (nr = 0 OR es > 0 OR er > 0 OR changed > 0)),
old AS (SELECT DISTINCT station FROM plan WHERE action = 'splice_write' AND 2002 - CAST(shard AS INT) > 3),
full_plan AS (SELECT * FROM plan UNION ALL SELECT station, param, shard, 'splice_write', 'escalated_due_to_old_change' FROM f WHERE ns > 0 AND station IN (SELECT station FROM old) AND (station, shard) NOT IN (SELECT (station, shard) FROM plan))"""


@query("rec1_shard_label", """WITH n AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'usgs_a_flow_' || year(o_orderdate) || '.csv' WHEN 1 THEN 'usgs_a_flow_' || year(o_orderdate) || '_9999.csv' ELSE 'usgs_a_flow.csv' END AS file, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(y AS VARCHAR) WHEN 1 THEN y || '_9999' ELSE '__single__' END AS shard, CAST(CASE o_orderkey % 3 WHEN 0 THEN y WHEN 1 THEN 9999 END AS INTEGER) AS end_year FROM n""")
def _(spark, sf):
    m, y = F.col("o_orderkey") % 3, F.year("o_orderdate").cast("string")
    name = F.when(m == 0, F.concat(F.lit("usgs_a_flow_"), y, F.lit(".csv"))).when(m == 1, F.concat(F.lit("usgs_a_flow_"), y, F.lit("_9999.csv"))).otherwise("usgs_a_flow.csv")
    d = table(spark, sf, "orders").select("o_orderkey", R.shard_label(name).alias("shard"))
    return d.withColumn("end_year", R.shard_end_year("shard"))


@query("rec2_content_hash", f"WITH {SIDES} SELECT station, param, shard, ns = nr AND es = 0 AND er = 0 AND changed = 0 AS same FROM f WHERE ns > 0 AND nr > 0")
def _(spark, sf):
    s, r = sides(spark, sf)
    a, b = (R.content_hash(x, K, ["ts", "value"]) for x in (s, r))
    j = a.alias("a").join(b.alias("b"), [*K, "shard"])
    return j.select(*K, "shard", ((F.col("a.n") == F.col("b.n")) & (F.col("a.digest") == F.col("b.digest"))).alias("same"))


_DRAW = "CAST(('0x' || left(sha256({}), 13)) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE"


@query("rec3_stable_sample", f"SELECT o_orderkey, round({_DRAW.format('CAST(o_orderkey AS VARCHAR)')}, 12) AS draw, {_DRAW.format('CAST(o_orderkey AS VARCHAR)')} < 0.15 AS chosen FROM orders")
def _(spark, sf):
    k = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select("o_orderkey", F.round(R.stable_draw(k), 12).alias("draw"), R.stable_sample(k, 0.15).alias("chosen"))


@query("rec4_inspect_rule", f"""WITH k AS (SELECT DISTINCT 's' || o_custkey AS series, CASE WHEN o_orderkey % 11 = 0 THEN '__single__' ELSE CAST(year(o_orderdate) + 5 AS VARCHAR) END AS shard FROM orders),
a AS (SELECT *, 2012 - TRY_CAST(shard AS INT) AS age FROM k) SELECT series, shard, CASE WHEN shard = '__single__' OR age < 7 THEN true WHEN age > 10 THEN {_DRAW.format("series || '|' || shard || '|p10'")} < 0.05 ELSE {_DRAW.format("series || '|' || shard || '|p3'")} < 0.15 END AS inspect FROM a""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    k = o.select(F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("series"),
                 F.when(F.col("o_orderkey") % 11 == 0, "__single__").otherwise((F.year("o_orderdate") + 5).cast("string")).alias("shard")).distinct()
    return k.withColumn("inspect", R.inspect_rule(F.col("series"), F.col("shard"), 2012, 7))


@query("rec5_values_differ", """SELECT l_orderkey, l_linenumber, (a IS DISTINCT FROM b) AS exact, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN abs(a - b) > 0.01 + 0.001 * abs(b) ELSE (a IS NULL) <> (b IS NULL) END AS tolerant
FROM (SELECT *, CASE WHEN l_tax > 0 THEN l_extendedprice END AS a, CASE WHEN l_discount > 0 THEN CASE WHEN l_linenumber = 2 THEN l_extendedprice + 5 ELSE l_extendedprice END END AS b FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    p = F.col("l_extendedprice")
    a, b = F.when(F.col("l_tax") > 0, p), F.when(F.col("l_discount") > 0, F.when(F.col("l_linenumber") == 2, p + 5).otherwise(p))
    return li.select("l_orderkey", "l_linenumber", R.values_differ(a, b).alias("exact"), R.values_differ(a, b, 0.01, 0.001).alias("tolerant"))


@query("rec6_plan_update", f"WITH {SIDES} SELECT * FROM plan")
def _(spark, sf):
    s, r = sides(spark, sf)
    return R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, regular=False, escalate=False)


@query("rec6_frequency_gate", f"""WITH {SIDES}, odd AS (SELECT DISTINCT station, param, shard FROM staged WHERE CAST(shard AS INT) BETWEEN 1996 AND 2000)
SELECT station, param, shard, 'quarantine_skip' AS action, 'both_regular_different' AS reason FROM odd UNION ALL SELECT DISTINCT station, param, shard, 'write', 'missing_in_repo' FROM staged WHERE shard = '2001'""")
def _(spark, sf):
    s, r = sides(spark, sf)
    return R.plan_update(s.filter(F.dayofyear("ts") % 2 == 0), r, K, YEAR, p3=1.0, p10=1.0, escalate=False)


def _ragged(d):
    """Days of a shard with no step of their own."""
    return d.filter((F.dayofyear("ts") % 7).isin(0, 1, 3))


for _name, _status, _action in (("dst_irregular", "dst_irregular", "replace_write"), ("src_irregular", "src_irregular", "quarantine_skip"),
                                ("both_irregular", "both_irregular", "quarantine_skip"), ("steps_replace", "both_regular_different", "replace_write")):
    @query(f"rec6_{_name}", f"""WITH {SIDES}, odd AS (SELECT DISTINCT station, param, shard FROM staged WHERE CAST(shard AS INT) BETWEEN 1996 AND 2000)
SELECT station, param, shard, '{_action}' AS action, '{_status}' AS reason FROM odd UNION ALL SELECT DISTINCT station, param, shard, 'write', 'missing_in_repo' FROM staged WHERE shard = '2001'""")
    def _(spark, sf, name=_name):
        s, r = sides(spark, sf)
        if name in ("src_irregular", "both_irregular"):
            s = _ragged(s).withColumn("value", F.col("value") + 1)
        if name in ("dst_irregular", "both_irregular"):
            r = _ragged(r)
        if name == "steps_replace":
            s = s.filter(F.dayofyear("ts") % 2 == 0)
        return R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, escalate=False, freq_mismatch="replace" if name == "steps_replace" else "quarantine")


@query("rec7_escalate", f"WITH {SIDES} SELECT * FROM full_plan")
def _(spark, sf):
    s, r = sides(spark, sf)
    return R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, regular=False)


@query("rec8_apply_update", f"""WITH {SIDES}, sp AS (SELECT station, param, shard, min(ts) AS a, max(ts) AS b FROM staged GROUP BY ALL)
SELECT s.station, s.param, s.shard, s.ts, s.value FROM staged s JOIN plan p USING (station, param, shard)
UNION ALL SELECT r.station, r.param, r.shard, r.ts, r.value FROM repo r JOIN plan p USING (station, param, shard) JOIN sp USING (station, param, shard) WHERE p.action = 'splice_write' AND NOT (r.ts BETWEEN sp.a AND sp.b)""")
def _(spark, sf):
    s, r = sides(spark, sf)
    plan = R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, regular=False, escalate=False)
    return R.apply_update(s, r, plan, K)


@query("rec8_apply_irregular", f"""WITH {SIDES}, sp AS (SELECT station, param, shard, min(ts) AS a FROM staged GROUP BY ALL)
SELECT s.station, s.param, s.shard, s.ts, s.value FROM staged s JOIN plan p USING (station, param, shard)
UNION ALL SELECT r.station, r.param, r.shard, r.ts, r.value FROM repo r JOIN plan p USING (station, param, shard) JOIN sp USING (station, param, shard) WHERE p.action = 'splice_write' AND r.ts < sp.a""")
def _(spark, sf):
    s, r = sides(spark, sf)
    plan = R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, regular=False, escalate=False)
    return R.apply_update(s, r, plan, K, regular=False)


@query("rec9_normalize_flag", """SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 4 THEN 0 WHEN 5 THEN 1 END AS TINYINT) AS user_flag FROM orders""")
def _(spark, sf):
    texts = F.array(*[F.lit(x) for x in ("", "0", "1", "NaN", "0.0", " 1.0 ")])
    return table(spark, sf, "orders").select("o_orderkey", R.normalize_flag(F.element_at(texts, (F.col("o_orderkey") % 6 + 1).cast("int"))).alias("user_flag"))


def flagged(spark, sf):
    s, r = sides(spark, sf)
    d = F.dayofmonth("ts")
    sf_ = F.when(d % 5 == 0, 1).when(d % 7 == 0, 0).cast("tinyint")
    rf = F.when(d % 3 == 0, 1).when(d % 4 == 0, 0).cast("tinyint")
    y = F.col("shard").isin("1996", "1998")
    return s.withColumn("user_flag", F.when(y, sf_)), r.withColumn("user_flag", F.when(y, rf))


_FLAGS = """, sfl AS (SELECT *, CAST(CASE WHEN shard IN ('1996', '1998') THEN CASE WHEN day(ts) % 5 = 0 THEN 1 WHEN day(ts) % 7 = 0 THEN 0 END END AS TINYINT) AS flag FROM staged),
rfl AS (SELECT *, CAST(CASE WHEN shard IN ('1996', '1998') THEN CASE WHEN day(ts) % 3 = 0 THEN 1 WHEN day(ts) % 4 = 0 THEN 0 END END AS TINYINT) AS flag FROM repo),
mj AS (SELECT coalesce(s.station, r.station) AS station, coalesce(s.param, r.param) AS param, coalesce(s.shard, r.shard) AS shard, coalesce(s.ts, r.ts) AS ts, s.value AS sv, r.value AS rv, s.flag AS sfg, r.flag AS rfg, r.ts IS NOT NULL AS in_repo
  FROM sfl s FULL JOIN rfl r USING (station, param, shard, ts)),
mf AS (SELECT *, CASE WHEN sv IS NOT NULL AND rv IS NOT NULL THEN sv <> rv ELSE NOT (sv IS NULL AND rv IS NULL) END AS different FROM mj),
merged AS (SELECT station, param, shard, ts, CASE WHEN different THEN sv ELSE rv END AS value, CASE WHEN different THEN sfg WHEN rfg IS NULL THEN sfg ELSE rfg END AS user_flag, in_repo, rv, rfg FROM mf)"""


@query("rec10_merge_flags", f"WITH {SIDES} {_FLAGS} SELECT station, param, shard, ts, value, user_flag FROM merged")
def _(spark, sf):
    s, r = flagged(spark, sf)
    return R.merge_flags(r, s, K).select(*K, "shard", "ts", "value", "user_flag")


_PLANF = """, pf AS (SELECT station, param, shard, count(*) FILTER (NOT in_repo OR value IS DISTINCT FROM rv OR user_flag IS DISTINCT FROM rfg) AS n, bool_or(in_repo) AS known FROM merged WHERE (station, shard) IN (SELECT (station, shard) FROM staged) GROUP BY ALL),
pplan AS (SELECT station, param, shard, 'write' AS action, CASE WHEN known THEN 'flag_or_value_merge_changed' ELSE 'missing_in_repo' END AS reason FROM pf WHERE n > 0)"""


@query("rec11_plan_flagged", f"WITH {SIDES} {_FLAGS} {_PLANF} SELECT * FROM pplan")
def _(spark, sf):
    s, r = flagged(spark, sf)
    return R.plan_flagged(s, r, K, YEAR)


@query("rec12_update_flagged", f"WITH {SIDES} {_FLAGS} {_PLANF} SELECT station, param, shard, ts, value, user_flag FROM merged WHERE (station, shard) IN (SELECT (station, shard) FROM pplan)")
def _(spark, sf):
    s, r = flagged(spark, sf)
    return R.apply_flagged(s, r, R.plan_flagged(s, r, K, YEAR), K)


@query("rec13_plan_summary", f"WITH {SIDES} SELECT (SELECT count(*) FROM f WHERE ns > 0) AS candidates, (SELECT count(*) FROM f WHERE ns > 0) AS inspected, (SELECT count(*) FROM plan) AS updates")
def _(spark, sf):
    s, r = sides(spark, sf)
    return R.plan_summary(R.plan_update(s, r, K, YEAR, p3=1.0, p10=1.0, regular=False, escalate=False), R.vet_shards(s, r, K, ["value"], YEAR, p3=1.0, p10=1.0), K)


@query("rec14_coverage_check", f"WITH {SIDES}, c AS (SELECT station, shard, nr AS repo_n, ns AS staged_n, greatest(CAST(ceil(0.8 * nr) AS BIGINT), 100) AS need FROM f WHERE nr > 0) SELECT *, staged_n >= need AS ok FROM c")
def _(spark, sf):
    s, r = sides(spark, sf)
    n = lambda d: d.groupBy("station", "shard").agg(F.count(F.lit(1)).alias("n"))
    return R.coverage_check(n(s), n(r), ["station", "shard"], 0.8, 100)


@query("rec15_year_coverage", """WITH s AS (SELECT o_custkey AS series, CAST(min(year(o_orderdate)) AS INT) AS a, CAST(min(year(o_orderdate)) + o_custkey % 3 AS INT) AS b, o_custkey % 7 <> 0 AS readable FROM orders GROUP BY o_custkey), q AS (SELECT DISTINCT o_custkey AS series, CAST(year(o_orderdate) AS INT) AS year FROM orders)
SELECT series, year FROM q WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.series = q.series AND readable AND q.year BETWEEN a AND b)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("series"), F.year("o_orderdate").alias("year"))
    s = o.groupBy("series").agg(F.min("year").alias("syear")).select("series", "syear", (F.col("syear") + F.col("series") % 3).cast("int").alias("eyear"), (F.col("series") % 7 != 0).alias("readable"))
    return R.year_coverage(o.distinct(), s, ["series"])


@query("rec15_failure_mask", "SELECT CAST(bit_or(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'P' THEN 4 ELSE 0 END) AS INTEGER) AS mask FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders")
    return R.failure_mask(o.select(F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 4).otherwise(0).alias("code")))


@query("rec16_only_series", f"WITH {SIDES} SELECT station, param, shard, ts, value FROM staged WHERE station IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority < '3')")
def _(spark, sf):
    s, r = sides(spark, sf)
    return R.only_series(s, r.filter("station < '3'"), K)


@query("rec17_quarantine", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.08 THEN 'discount' END AS reason FROM lineitem")
def _(spark, sf):
    good, bad = split(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), F.col("l_discount") > 0.08, "discount")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad).drop("l_discount")


_TOP = """WITH h AS (SELECT event_type AS station, 'p' || (user_id % 3) AS param, date_trunc('hour', ts) AS ts, event_id % 4 AS b, max(value) AS value FROM events GROUP BY ALL)
SELECT station, param, CAST(month(ts) AS VARCHAR) AS shard, ts, last(value ORDER BY b) AS value FROM h GROUP BY station, param, ts"""


def _batches(spark, sf):
    e = table(spark, sf, "events")
    h = e.groupBy(F.col("event_type").alias("station"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("param"),
                  F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), (F.col("event_id") % 4).alias("b")).agg(F.max("value").alias("value"))
    return h.withColumn("shard", F.month("ts").cast("string")).select(*K, "shard", "ts", "value", "b")


@query("str1_stream_topoff", _TOP)
def _(spark, sf):
    root = scratch(spark, "topoff")
    h = stage(_batches(spark, sf))
    rows = h.drop("b").schema
    for b in range(4):  # one arrival after the other; the same stream goes on from its checkpoint
        h.filter(F.col("b") == b).drop("b").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(rows).parquet(f"{root}/in")
        stream_topoff(src, f"{root}/repo", f"{root}/cp", K).awaitTermination()
    return read_repository(spark, f"{root}/repo", rows).select("station", "param", "shard", "ts", "value")
