"""SRC queries.  Text lines and payloads are derived from the given tables and
read back by the readers, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import K, OBS, obs, query, table
from tidewell.sources import lines as L, payloads as P, shards as SH
from tidewell.session import scratch, stage


def _fmt(pattern, c="ts"):
    return F.date_format(c, pattern)


def _batch(key):
    """A payload holds at most 64 points, however many a site has."""
    return F.floor(F.col(key) / 64).alias("batch")


def rows(spark, sf):
    e = table(spark, sf, "events")
    q = F.element_at(F.array(*[F.lit(x) for x in ("1", "70", "e", "X", "")]), (F.col("event_id") % 5 + 1).cast("int"))
    v = F.when(F.col("event_id") % 17 == 0, "Eqp").when(F.col("event_id") % 19 == 0, "---").otherwise(F.col("value").cast("string"))
    return e.select((F.col("user_id") % 19).alias("k"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_id").alias("id"), v.alias("v"), q.alias("q"), "value")


ROWS = """rw AS (SELECT user_id % 19 AS k, date_trunc('minute', ts) AS ts, event_id AS id, CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE value END AS v, CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN '70' WHEN 2 THEN 'e' WHEN 3 THEN 'X' ELSE '' END AS q FROM events)"""

# layout, header lines, the text of a data row
_D = "yyyy-MM-dd HH:mm"
KINDS = [
    ("usgs_json", ["# format: agency-1.0", "# format_modifier: parse-usgs-json", "datetime,901_value,901_qualifiers"], lambda: F.concat_ws(",", _fmt(_D), "v", F.lit("A"))),
    ("screened", ["# format: agency-1.0", "# unit: cfs", "datetime,value,user_flag"], lambda: F.concat_ws(",", _fmt(_D), "v", F.when(F.col("q") == "X", "1").otherwise(""))),
    ("canonical", ["# format: agency-1.0", "# unit: cfs", "datetime,value"], lambda: F.concat_ws(",", _fmt(_D), "v")),
    ("usgs_rdb", ["# waterdata.usgs.gov", "agency_cd\tsite_no\tdatetime\ttz_cd\t901_00060\t901_00060_cd", "5s\t15s\t20d\t6s\t14n\t10s"],
     lambda: F.concat_ws("\t", F.lit("USGS"), F.lit("11"), _fmt(_D), F.lit("PST"), "v", F.when(F.col("q") == "X", "Z").otherwise("A"))),
    ("usgs_unit", ["# //United States Geological Survey", "DATE\tTIME\tTZCD\tVALUE\tQA"], lambda: F.concat_ws("\t", _fmt("yyyyMMdd"), _fmt("HHmmss"), F.lit("PST"), "v", F.when(F.col("q") == "X", "Z").otherwise(""))),
    ("usgs_csv", ["# CSV data starts at line 3", "ISO 8601 UTC,Timestamp (UTC-08:00),Value,Approval Level"], lambda: F.concat_ws(",", _fmt("yyyy-MM-dd'T'HH:mm'Z'"), _fmt(_D), "v", F.when(F.col("q") == "X", "Z").otherwise("Approved"))),
    ("usgs_daily", ["# waterdata.usgs.gov", "agency_cd\tsite_no\tdatetime\t901_00060_00003\t901_00060_00003_cd", "5s\t15s\t20d\t14n\t10s"],
     lambda: F.concat_ws("\t", F.lit("USGS"), F.lit("11"), _fmt(_D), "v", F.when(F.col("q") == "X", "Z").otherwise("A:e"))),
    ("noaa", ["# agency: noaa", "Date Time, Water Level, Quality"], lambda: F.concat_ws(",", _fmt(_D), "v", F.when(F.col("q") == "X", "Z").otherwise("v"))),
    ("des", ["RESULT_ID export", "ROW# list", "RESULT_ID,DATETIME,VALUE,QAQC Flag"], lambda: F.concat_ws(",", "id", _fmt(_D), "v", F.when(F.col("q") == "X", "Z").otherwise("G"))),
    ("des_std", ["# provider = agency-des", "time,value,qaqc_flag_id"], lambda: F.concat_ws(",", _fmt(_D), "v", F.when(F.col("q") == "X", "Z").otherwise("U"))),
    ("cdec_csv1", ["Title: \"FLOW\"", "'PST Date','Time','Value'"], lambda: F.concat_ws(",", _fmt("yyyyMMdd"), _fmt("HHmm"), "v")),
    ("cdec_csv2", ["STATION_ID,DURATION,SENSOR_NUMBER,SENSOR_TYPE,DATE TIME,OBS DATE,VALUE,DATA_FLAG,UNITS"],
     lambda: F.concat_ws(",", F.lit("AAA"), F.lit("E"), F.lit("20"), F.lit("FLOW"), _fmt("yyyyMMdd HHmm"), _fmt("yyyyMMdd HHmm"), "v", F.when(F.col("q") == "X", "v").otherwise("e"), F.lit("CFS"))),
    ("hydstra_json", ["# format: agency-ncro-json", "datetime,value,qaqc_code"], lambda: F.concat_ws(",", _fmt("yyyy-MM-dd'T'HH:mm:ss"), "v", "q")),
    ("hydstra_csv", ["# provider = agency-ncro", "datetime,value,qaqc_code"], lambda: F.concat_ws(",", _fmt(_D), "v", "q", F.lit("x"))),
    ("wdl3", ['"Time","FLOW"', '"and",""', '"Date","Value"'], lambda: F.concat_ws(",", _fmt("MM/dd/yyyy HH:mm:ss"), "v", "q")),
    ("wdl2", ['"Date","Point"', 'Site,"Qual"'], lambda: F.concat_ws(",", _fmt("M/d/yyyy H:mm"), "v", "q", F.lit("note"))),
    ("wdl", [], lambda: F.concat_ws(",", _fmt("M/d/yyyy H:mm"), "v", "q", F.lit(""))),
    ("any_csv", ["time;of day", "stamp,reading"], lambda: F.concat_ws(",", _fmt(_D), "v")),
    ("vtide", ["# tide"], lambda: F.concat_ws("  ", _fmt("yyyyMMdd"), _fmt("HHmm"), "v")),
]
_OPEN = ("canonical", "cdec_csv1", "any_csv", "vtide", "usgs_json")  # no quality code in the text


def text_files(spark, sf, kinds=KINDS):
    """Each event as a line of the file of its user class, in the layout of the file."""
    r = rows(spark, sf)
    head = [(f"f{i:02d}.csv", j, line) for i, (_, lines, _) in enumerate(kinds) for j, line in enumerate(lines)]
    h = spark.createDataFrame(head, "file string, line_no long, line string")
    line = None
    for i, (_, _, fn) in enumerate(kinds):
        line = F.when(F.col("k") == i, fn()) if line is None else line.when(F.col("k") == i, fn())
    d = r.filter(F.col("k") < len(kinds)).select(F.format_string("f%02d.csv", F.col("k").cast("int")).alias("file"), (F.col("id") + 1000).alias("line_no"), line.alias("line"))
    return h.join(d.select("file").distinct(), "file", "left_semi").unionByName(d)


_KIND_SQL = "(VALUES " + ", ".join(f"({i}, '{k}', {'true' if k in _OPEN else 'false'})" for i, (k, _, _) in enumerate(KINDS)) + ") kind(k, layout, open)"


@query("src1_read_canonical", f"WITH {OBS} SELECT station || '.csv' AS file, ts, max(value) AS value FROM (SELECT station, date_trunc('hour', ts) AS ts, value FROM obs) GROUP BY ALL")
def _(spark, sf):
    o = obs(spark, sf).groupBy("station", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("value"))
    root = scratch(spark, "canon")
    o.select("station", _fmt("yyyy-MM-dd HH:mm").alias("datetime"), "value", F.lit(None).cast("string").alias("user_flag")) \
        .write.partitionBy("station").option("header", True).csv(f"{root}/t")
    # one folder per station, as a provider delivers them
    d = L.read_canonical(spark, f"{root}/t/*/*", with_path=True)
    return d.select(F.concat(F.regexp_extract("path", "station=([^/]+)", 1), F.lit(".csv")).alias("file"), "ts", "value")


def headed_files(spark, sf):
    """Events as canonical files whose columns stand in four orders, with some bad records."""
    e = table(spark, sf, "events").select(F.concat(F.lit("k"), (F.col("user_id") % 4).cast("string"), F.lit(".csv")).alias("file"), (F.col("user_id") % 4).alias("k"),
                                          (F.col("event_id") + 100).alias("line_no"), F.col("event_id").alias("id"), "ts", "value", "event_type")
    t = F.when(F.col("id") % 500 == 11, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    v = F.when(F.col("id") % 500 == 7, "oops").when(F.col("id") % 9 == 0, "").otherwise(F.col("value").cast("string"))
    flag = F.when(F.col("id") % 7 == 0, "1").when(F.col("id") % 7 == 1, "0").otherwise("")
    quoted = F.concat(F.lit('"'), "event_type", F.lit(', main"'))
    line = (F.when(F.col("k") == 0, F.concat_ws(",", t, v, flag)).when(F.col("k") == 1, F.concat_ws(",", flag, t, v))
            .when(F.col("k") == 2, F.concat_ws(",", v, quoted, t, F.when(F.col("id") % 500 == 13, "9,9").otherwise("2.5"))).otherwise(F.concat_ws(",", quoted, v)))
    heads = [("k0.csv", ["# format: canonical-1.0", "# unit: ft", "datetime,value,user_flag"]), ("k1.csv", ["# format: canonical-1.0", "user_flag,datetime,value"]),
             ("k2.csv", ["# format: canonical-1.0", "# dtypes:", "#   mode: str", "#   height: float", "# unit: ft", "value,mode,datetime,height"]), ("k3.csv", ["# dtypes: {mode: category}", "mode,value"])]
    h = spark.createDataFrame([(f, i, x) for f, lines in heads for i, x in enumerate(lines)], "file string, line_no long, line string")
    return h.join(e.select("file").distinct(), "file", "left_semi").unionByName(e.select("file", "line_no", line.alias("line")))


_HEADED = """e AS (SELECT *, user_id % 4 AS k, event_id AS id, CASE WHEN event_id % 500 = 13 AND user_id % 4 = 2 THEN 'wrong number of fields' WHEN user_id % 4 = 3 THEN 'no time column'
 WHEN event_id % 500 = 11 THEN 'bad time' WHEN event_id % 500 = 7 THEN 'text in numeric column value' END AS reason FROM events)"""


@query("src1_read_headed", f"""WITH {_HEADED} SELECT 'k' || k || '.csv' AS file, date_trunc('second', ts) AS ts, CASE WHEN id % 9 <> 0 THEN value END AS value,
 CASE WHEN k = 2 THEN NULL WHEN id % 7 = 0 THEN 1 WHEN id % 7 = 1 THEN 0 END AS user_flag, CASE WHEN k = 2 THEN 2.5::DOUBLE END AS height, CASE WHEN k = 2 THEN event_type || ', main' END AS mode FROM e WHERE reason IS NULL""")
def _(spark, sf):
    d = L.read_headed(headed_files(spark, sf))[0]
    return d.select("file", "ts", "value", "user_flag", F.try_element_at("numbers", F.lit("height")).alias("height"), F.try_element_at("texts", F.lit("mode")).alias("mode"))


@query("src1_quarantine", f"WITH {_HEADED} SELECT 'k' || k || '.csv' AS file, id + 100 AS line_no, reason FROM e WHERE reason IS NOT NULL")
def _(spark, sf):
    return L.read_headed(headed_files(spark, sf))[1].select("file", F.col("at.mid").alias("line_no"), "reason")


@query("src2_read_provider", f"""WITH {ROWS}, {"l AS (SELECT * FROM rw JOIN " + _KIND_SQL + " USING (k))"},
x AS (SELECT format('f{{:02d}}.csv', k) AS file, layout, ts, id, CASE WHEN open OR (q <> 'X' AND NOT (q = '70' AND layout IN ('wdl2', 'wdl3'))) THEN v END AS value FROM l)
SELECT file, ts, first(value ORDER BY id) AS value FROM (SELECT file, ts, id, value FROM x) GROUP BY file, ts""".replace("first(value ORDER BY id)", "arg_min_null(value, id)"))
def _(spark, sf):
    t = stage(text_files(spark, sf))  # written once, as a provider's files are: what reads it does not make the text again
    known = L.describe_files(t)  # a tide file has no signature; its layout is given
    known = known.withColumn("layout", F.when(F.col("file") == f"f{len(KINDS) - 1:02d}.csv", "vtide").otherwise(F.col("layout")))
    return L.read_provider(t, described=known).select("file", "ts", "value")


@query("src3_detect_layout", f"SELECT format('f{{:02d}}.csv', k) AS file, CASE WHEN layout = 'vtide' THEN 'any_csv' ELSE layout END AS layout FROM {_KIND_SQL} WHERE k IN (SELECT user_id % 19 FROM events)")
def _(spark, sf):
    return L.detect_layout(text_files(spark, sf))


@query("src4_null_tokens", f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN '5' ELSE 'odd' END AS v FROM events")
def _(spark, sf):
    t = F.element_at(F.array(*[F.lit(x) for x in (" *** ", "Ssn", "5", "odd")]), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", L.null_tokens(t).alias("v"))


@query("src5_strict_cast", "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 50 = 0 THEN 'b' || event_id END AS raw FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.lit("f").alias("file"), F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("b"), F.col("event_id").cast("string"))).otherwise(F.col("value").cast("string")).alias("raw"))
    good, bad = L.strict_cast(e, "raw", quarantine=True)
    return good.select("event_id", "value", F.lit(None).cast("string").alias("raw")).unionByName(bad.select("event_id", F.lit(None).cast("double").alias("value"), "raw"))


@query("src6_header_catalog", """SELECT 'c' || c_custkey AS file, CASE WHEN c_custkey % 10 < 2 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 10 < 2 THEN NULL ELSE c_mktsegment END AS segment,
 CASE c_custkey % 10 WHEN 0 THEN 'bad_prefix' WHEN 1 THEN 'indented_first_key' END AS problem FROM customer""")
def _(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    first = F.when(k % 10 == 1, F.concat(F.lit("#   name: "), "c_name")).when(k % 10 == 0, F.concat(F.lit("#name: "), "c_name")).otherwise(F.concat(F.lit("# name: '"), "c_name", F.lit("'")))
    lines = c.select(F.concat(F.lit("c"), k.cast("string")).alias("file"), F.posexplode(F.array(
        first, F.concat(F.lit("# segment: "), "c_mktsegment"), F.lit("# original_header: |"), F.lit("#   nested: text"), F.lit("datetime,value"), F.lit("# late: comment"))).alias("line_no", "line"))
    h = L.header_catalog(lines.withColumn("line_no", F.col("line_no").cast("long")))
    return h.select("file", F.try_element_at("header", F.lit("name")).alias("name"), F.try_element_at("header", F.lit("segment")).alias("segment"), "problem")


@query("src7_read_flagged", f"WITH {OBS} SELECT station, param, ts, CASE WHEN seq % 9 = 0 THEN NULL ELSE value END AS value FROM obs WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-09'")
def _(spark, sf):
    d = obs(spark, sf).withColumn("user_flag", F.when(F.col("seq") % 9 == 0, 1).when(F.col("seq") % 9 == 1, 0).cast("tinyint"))
    return SH.read_flagged(d.select(*K, "ts", "value", "user_flag"), "2024-01-03 00:00:00", "2024-01-09 00:00:00")


def _sparse(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 40).cast("string").alias("station"), F.col("o_orderstatus").alias("param"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"), "o_orderkey")
    return o.groupBy(*K, "ts").agg(F.min_by("value", "o_orderkey").alias("value"))


_SPARSE = "sp AS (SELECT CAST(o_custkey % 40 AS VARCHAR) AS station, o_orderstatus AS param, o_orderdate AS ts, arg_min(o_totalprice, o_orderkey) AS value FROM orders GROUP BY ALL), sy AS (SELECT *, CAST(year(ts) // 2 * 2 AS INT) AS shard_year FROM sp)"


@query("src8_write_shards", f"WITH {_SPARSE} SELECT station, param, ts, value, shard_year FROM sy WHERE (station, param, shard_year) IN (SELECT (station, param, shard_year) FROM sy GROUP BY station, param, shard_year HAVING count(value) >= 16)")
def _(spark, sf):
    root = scratch(spark, "shards")
    SH.write_shards(_sparse(spark, sf), f"{root}/store", K, block_years=2)
    d = SH.read_shards(spark, f"{root}/store")
    return d.select(F.col("station").cast("string").alias("station"), F.col("param").cast("string").alias("param"), "ts", "value", F.col("shard_year").cast("int").alias("shard_year"))


@query("src9_year_meta", f"WITH {_SPARSE} SELECT DISTINCT station, param, shard_year FROM sy WHERE shard_year = 1996")
def _(spark, sf):
    d = SH.with_shard_year(_sparse(spark, sf), 2)
    meta = d.select(*K, F.col("shard_year").alias("year")).distinct().filter("year != 1996")
    return SH.missing_year_meta(d, meta, K)


@query("src10_usgs_json", "SELECT CAST(user_id AS VARCHAR) AS site, '00060' AS var, '1' || (event_id % 3) AS ts_id, event_type AS method, date_trunc('second', ts) AS ts, value, CASE WHEN event_id % 2 = 0 THEN 'A,R' ELSE 'P' END AS qualifiers FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    utc = F.col("ts") + F.expr("INTERVAL 8 HOURS")
    point = F.struct(F.col("value").cast("string").alias("value"), F.concat(F.date_format(utc - F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit(".000-07:00")).alias("dateTime"),
                     F.when(F.col("event_id") % 2 == 0, F.array(F.lit("A"), F.lit("R"))).otherwise(F.array(F.lit("P"))).alias("qualifiers"))
    vals = e.groupBy("user_id", (F.col("event_id") % 3).alias("m"), "event_type", _batch("event_id")).agg(F.collect_list(point).alias("value"))
    vals = vals.select("user_id", F.struct(F.array(F.struct((F.col("m") + 10).alias("methodID"), F.col("event_type").alias("methodDescription"))).alias("method"), "value").alias("b"))
    ts = F.array(F.struct(F.struct(F.array(F.struct(F.col("user_id").cast("string").alias("value"))).alias("siteCode"),
                                   F.struct(F.struct(F.lit("-08:00").alias("zoneOffset")).alias("defaultTimeZone")).alias("timeZoneInfo")).alias("sourceInfo"),
                          F.struct(F.array(F.struct(F.lit("00060").alias("value"))).alias("variableCode")).alias("variable"), F.array("b").alias("values")))
    return P.flatten_usgs_json(vals.select(F.to_json(F.struct(F.struct(ts.alias("timeSeries")).alias("value"))).alias("payload")))


@query("src11_usgs_daily_json", "SELECT o_orderpriority AS station, o_orderdate AS ts, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS value FROM orders WHERE o_orderkey % 8 <> 0")
def _(spark, sf):
    o = table(spark, sf, "orders")
    t = F.when(F.col("o_orderkey") % 8 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("")
    f = F.struct(F.struct(t.alias("time"), F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("value")).alias("properties"))
    p = o.groupBy("o_orderpriority", _batch("o_orderkey")).agg(F.collect_list(f).alias("features"))
    return P.flatten_usgs_daily_json(p.select(F.col("o_orderpriority").alias("station"), F.to_json(F.struct("features")).alias("payload")), keep=("station",))


@query("src12_trace_json", "SELECT CAST(user_id AS VARCHAR) AS site, date_trunc('second', ts) AS ts, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value, CAST(event_id % 4 AS VARCHAR) AS quality FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    r = F.struct(F.date_format("ts", "yyyyMMddHHmmss").alias("t"), F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("value").cast("string")).alias("v"), (F.col("event_id") % 4).cast("string").alias("q"))
    g = e.groupBy("user_id", _batch("event_id")).agg(F.collect_list(r).alias("trace"))
    tr = F.array(F.struct(F.col("user_id").cast("string").alias("site"), "trace"))
    return P.flatten_trace_json(g.select(F.to_json(F.struct(F.struct(tr.alias("traces")).alias("return"))).alias("payload")))


@query("src13_inventory_json", """SELECT DISTINCT 'B' || (o_custkey % 300) AS site, o_orderstatus || '_RAW' AS trace, date_trunc('year', o_orderdate) AS start, date_trunc('year', o_orderdate) + INTERVAL 300 DAY AS "end" FROM orders WHERE o_custkey % 300 <> 7 AND o_orderpriority < '4'""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    y = F.date_trunc("year", "o_orderdate")
    t = F.struct(F.concat("o_orderstatus", F.when(F.col("o_orderpriority") < "4", "_RAW").otherwise("_QC")).alias("trace"), F.date_format(y, "yyyy-MM-dd HH:mm:ss").alias("start_time"),
                 F.date_format(y + F.expr("INTERVAL 300 DAYS"), "yyyy-MM-dd HH:mm:ss").alias("end_time"))
    k = F.col("o_custkey") % 300
    s = o.groupBy(k.alias("k"), _batch("o_orderkey")).agg(F.collect_list(t).alias("traces"))
    site = F.struct(F.when(F.col("k") != 7, F.concat(F.lit("B"), F.col("k").cast("string"))).alias("site"), "traces")
    return P.flatten_inventory_json(s.select(F.to_json(F.struct(F.struct(F.array(site).alias("sites")).alias("return"))).alias("payload")))


@query("src14_hourly_station", """WITH h AS (SELECT 's' || (user_id % 10) AS station, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, event_id % 3 AS part, round(max(value), 2) AS temp, count(*)::DOUBLE AS n FROM events GROUP BY ALL)
SELECT station, ts, last(temp ORDER BY part) AS temp, last(n ORDER BY part) AS n FROM h GROUP BY station, ts""")
def _(spark, sf):
    e = table(spark, sf, "events")
    h = e.groupBy(F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string")).alias("station"), F.date_trunc("hour", "ts").alias("t"), (F.col("event_id") % 3).alias("part")).agg(
        F.round(F.max("value"), 2).cast("string").alias("temp"), F.count(F.lit(1)).cast("string").alias("n"))
    h = h.withColumn("date", F.date_format("t", "M/d/yyyy")).withColumn("hour", F.format_string("%02d00", F.hour("t") + 1))
    return SH.hourly_station([h.filter(F.col("part") == i) for i in range(3)], ["station"], ["temp", "n"])


@query("src15_daily_manifest", "SELECT 's' || c_custkey AS station_id, 'flow' AS param, CASE WHEN c_custkey % 2 = 0 THEN 'cdec' ELSE 'usgs' END AS provider FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer")
    m = c.select(F.concat(F.lit(" s"), F.col("c_custkey").cast("string")).alias("station_id"), F.lit("flow ").alias("param"), F.when(F.col("c_custkey") % 2 == 0, "CDEC").otherwise("usgs").alias("provider"))
    return SH.read_daily_manifest(m, ["cdec", "usgs"])


@query("src15_manifest_problems", """SELECT 's' || (c_custkey // 2) AS station_id, 'flow' AS param, 'cdec' AS provider, 'duplicate' AS problem FROM customer WHERE c_custkey // 2 % 5 <> 0 GROUP BY c_custkey // 2 HAVING count(*) > 1
UNION ALL SELECT 's' || (c_custkey // 2), 'flow', 'nobody', 'unsupported_provider' FROM customer WHERE c_custkey // 2 % 5 = 0
UNION ALL SELECT 's' || (c_custkey // 2), 'flow', 'nobody', 'duplicate' FROM customer WHERE c_custkey // 2 % 5 = 0 GROUP BY c_custkey // 2 HAVING count(*) > 1""")
def _(spark, sf):
    k = F.floor(F.col("c_custkey") / 2)
    m = table(spark, sf, "customer").select(F.concat(F.lit("s"), k.cast("string")).alias("station_id"), F.lit("flow").alias("param"), F.when(k % 5 == 0, "nobody").otherwise("cdec").alias("provider"))
    return SH.manifest_problems(m, ["cdec", "usgs"])
