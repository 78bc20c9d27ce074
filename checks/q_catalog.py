"""CAT, JOIN-1..7, UDF-1, PRD-17/18 queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import OBS, obs, query, table
from tidewell.functions import names as N
from tidewell.operators import request as RQ
from tidewell.plans import catalog as C, steps as ST
from tidewell.schema import ntz


def file_names(spark, sf):
    """One file per customer and order year, some with sublocation or a span."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y")).distinct()
    c, y = F.col("o_custkey"), F.col("y").cast("string")
    src = F.when(c % 2 == 0, "usgs").otherwise("cdec")
    sub = F.when(c % 3 == 0, "@upper").otherwise("")
    yr = F.when(c % 5 == 0, F.concat(y, F.lit("_"), (F.col("y") + 1).cast("string"))).otherwise(y)
    return o.select("o_custkey", "y", F.concat(src, F.lit("_s"), (c % 300).cast("string"), sub, F.lit("_a"), (c % 300).cast("string"), F.lit("_flow_"), yr, F.lit(".csv")).alias("file"))


FILES = """fn AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders),
files AS (SELECT o_custkey, y, CASE WHEN o_custkey % 2 = 0 THEN 'usgs' ELSE 'cdec' END AS source, 's' || (o_custkey % 300) AS station_id, CASE WHEN o_custkey % 3 = 0 THEN 'upper' ELSE 'default' END AS subloc, 'a' || (o_custkey % 300) AS agency_id, 'flow' AS param,
 CASE WHEN o_custkey % 5 = 0 THEN y || '_' || (y + 1) ELSE y || '' END AS yr FROM fn),
named AS (SELECT *, source || '_' || station_id || CASE WHEN subloc = 'upper' THEN '@upper' ELSE '' END || '_' || agency_id || '_flow_' || yr || '.csv' AS file FROM files)"""


def parsed(spark, sf):
    return file_names(spark, sf).select("file", N.parse_name("file").alias("m")).select("file", "m.*")


def registry(spark, sf):
    """A station for each customer; every thirtieth is not registered."""
    c = table(spark, sf, "customer").filter("c_custkey % 30 <> 0")
    k = F.col("c_custkey").cast("string")
    return c.select(F.concat(F.lit("s"), k).alias("station_id"), F.col("c_name").alias("station_name"), F.concat(F.lit("a"), k).alias("agency_id"),
                    F.when(F.col("c_nationkey") % 2 == 0, "usgs").otherwise("ncro").alias("agency"), F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y"))


REG = """reg AS (SELECT 's' || c_custkey AS station_id, c_name AS station_name, 'a' || c_custkey AS agency_id, CASE WHEN c_nationkey % 2 = 0 THEN 'usgs' ELSE 'ncro' END AS agency, c_acctbal AS x, c_nationkey::DOUBLE AS y FROM customer WHERE c_custkey % 30 <> 0)"""


@query("cat1_parse_name", f"""WITH {FILES} SELECT file, source, station_id, subloc, agency_id, param, NULL AS modifier, CASE WHEN o_custkey % 5 <> 0 THEN CAST(y AS VARCHAR) END AS year,
 CASE WHEN o_custkey % 5 = 0 THEN CAST(y AS VARCHAR) END AS syear, CASE WHEN o_custkey % 5 = 0 THEN CAST(y + 1 AS VARCHAR) END AS eyear FROM named""")
def _(spark, sf):
    return parsed(spark, sf)


@query("cat2_render_name", f"WITH {FILES} SELECT file, file AS name, source || '_' || station_id || CASE WHEN subloc = 'upper' THEN '@upper' ELSE '' END || '_' || agency_id || '_flow.csv' AS shardless FROM named")
def _(spark, sf):
    p = parsed(spark, sf)
    f = {k: F.col(k) for k in N.FIELDS}
    return p.select("file", N.render_name(f).alias("name"), N.render_name(f, include_shard=False).alias("shardless"))


@query("cat3_wildcard_name", f"WITH {FILES} SELECT file, replace(file, '_' || yr || '.', '_*.') AS pattern, '*' || substr(replace(file, '_' || yr || '.', '_*.'), 5) AS any_provider FROM named")
def _(spark, sf):
    return file_names(spark, sf).select("file", N.wildcard_name("file").alias("pattern"), N.wildcard_name("file", True).alias("any_provider"))


@query("cat4_series_id", f"WITH {FILES} SELECT file, source || '|' || station_id || CASE WHEN subloc = 'upper' THEN '|upper' ELSE '' END || '|flow' AS series_id FROM named")
def _(spark, sf):
    p = parsed(spark, sf)
    return p.select("file", N.series_id({k: F.col(k) for k in N.FIELDS}, provider="source").alias("series_id"))


_INV = f"{FILES}, {REG}, inv AS (SELECT *, replace(file, '_' || yr || '.', '_*.') AS file_pattern FROM named)"


@query("cat5_file_inventory", f"""WITH {_INV} SELECT file_pattern, first(source ORDER BY file) AS source, first(station_id ORDER BY file) AS station_id, first(subloc ORDER BY file) AS subloc, first(agency_id ORDER BY file) AS agency_id, 'flow' AS param,
 CAST(min(y) AS INT) AS min_year, CAST(max(CASE WHEN o_custkey % 5 = 0 THEN y + 1 ELSE y END) AS INT) AS max_year, any_value(station_name) AS station_name, any_value(agency) AS agency, any_value(x) AS x, any_value(reg.y2) AS y, any_value('ft^3/s') AS unit
FROM inv LEFT JOIN (SELECT station_id, station_name, agency, x, y AS y2 FROM reg) reg USING (station_id) GROUP BY file_pattern""")
def _(spark, sf):
    p = parsed(spark, sf)
    units = p.select(N.wildcard_name("file").alias("file_pattern")).distinct().withColumn("unit", F.lit("ft^3/s"))
    return C.file_inventory(p, registry(spark, sf), units)


@query("cat6_data_inventory", f"""WITH {_INV} SELECT station_id || CASE WHEN subloc = 'upper' THEN '|upper' ELSE '' END || '|flow' AS series_id, any_value(station_id) AS station_id, any_value(subloc) AS subloc, 'flow' AS param,
 CAST(min(y) AS INT) AS min_year, CAST(max(CASE WHEN o_custkey % 5 = 0 THEN y + 1 ELSE y END) AS INT) AS max_year FROM inv GROUP BY 1""")
def _(spark, sf):
    return C.data_inventory(parsed(spark, sf))


def two_registries(spark, sf):
    r = registry(spark, sf)
    a = r.withColumn("agency_id", F.concat(F.lit("'"), "agency_id", F.lit("' ")))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("q"), F.col("s_suppkey").cast("string")).alias("station_id"), F.col("s_name").alias("station_name"),
                                            F.col("s_suppkey").cast("string").alias("agency_id"), F.lit("cdec").alias("agency"))
    return {"continuous": a, "processed": s}


_UREG = f"""{REG}, ureg AS (SELECT *, 'continuous' AS registry FROM reg UNION ALL SELECT 'q' || s_suppkey, s_name, CAST(s_suppkey AS VARCHAR), 'cdec', NULL, NULL, 'processed' FROM supplier)"""


@query("cat7_union_registries", f"WITH {_UREG} SELECT * FROM ureg")
def _(spark, sf):
    return C.union_registries(two_registries(spark, sf))


@query("cat7_registry_problems", """WITH b AS (SELECT 's' || c_custkey AS station_id, CASE WHEN c_custkey % 7 <> 0 THEN 'a' END AS agency_id FROM customer), d AS (SELECT 's' || s_suppkey AS station_id FROM supplier)
SELECT station_id, 'in_several_registries' AS problem FROM d WHERE station_id IN (SELECT station_id FROM b) UNION ALL SELECT station_id, 'no_agency_id' FROM b WHERE agency_id IS NULL""")
def _(spark, sf):
    a = table(spark, sf, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("station_id"), F.when(F.col("c_custkey") % 7 != 0, "a").alias("agency_id"))
    b = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("station_id"), F.lit("b").alias("agency_id"))
    return C.registry_problems({"a": a, "b": b})


@query("cat8_search_registry", f"WITH {_UREG} SELECT * FROM ureg WHERE lower(station_id) LIKE '%00007%' OR lower(station_name) LIKE '%00007%' OR lower(agency_id) LIKE '%00007%' OR lower(agency) LIKE '%00007%'")
def _(spark, sf):
    return C.search_registry(two_registries(spark, sf), "00007")


@query("cat9_filter_inventory", f"WITH {FILES} SELECT file, station_id, param FROM named WHERE station_id IN ('s1', 's2', 's30') AND param = 'flow'")
def _(spark, sf):
    return C.filter_inventory(parsed(spark, sf), ["s1", "s2", "s30"], ["flow"]).select("file", "station_id", "param")


@query("cat10_valid_span", """WITH c AS (SELECT o_custkey, year(o_orderdate) AS y, CASE WHEN o_orderstatus = 'F' AND o_custkey % 4 <> 0 THEN o_totalprice END AS value, o_custkey % 10 = 1 AS open FROM orders)
SELECT o_custkey, CAST(min(y) FILTER (value IS NOT NULL) AS INT) AS syear, CAST(CASE WHEN bool_or(open) THEN 9999 ELSE max(y) FILTER (value IS NOT NULL) END AS INT) AS eyear, count(value) = 0 AS empty FROM c GROUP BY o_custkey""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("value", F.when((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 4 != 0), F.col("o_totalprice")))
    return C.valid_span(o, ["o_custkey"], F.col("o_custkey") % 10 == 1, ts="o_orderdate")


@query("cat11_drop_held", f"WITH {FILES}, {REG} SELECT station_id, 'flow' AS param FROM reg WHERE station_id NOT IN (SELECT station_id FROM named WHERE source = 'usgs')")
def _(spark, sf):
    return C.drop_held(registry(spark, sf).select("station_id", F.lit("flow").alias("param")), parsed(spark, sf).filter("source = 'usgs'"))


@query("cat12_min_rows", "SELECT o_custkey, o_orderkey, o_totalprice AS value FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) >= 8)")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("v", F.when(F.col("o_orderstatus") != "P", 1))
    return C.min_rows_filter(o, ["o_custkey"], 8, "v", ts="o_orderdate").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("value"))


@query("cat13_infer_unit", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'feet' WHEN 1 THEN 'special' WHEN 2 THEN 'uS/cm' WHEN 3 THEN 'ft^3/s' WHEN 4 THEN 'unknown' ELSE 'deg_f' END AS unit FROM orders""")
def _(spark, sf):
    m = F.col("o_orderkey") % 6
    raw = F.when(m == 0, " Feet").when(m == 1, "CFS").when(m == 2, "microSiemens/cm").when(m == 3, "misc").when(m == 4, "bananas").otherwise("DEG F")
    d = table(spark, sf, "orders").select("o_orderkey", F.when(m == 1, "odd").otherwise("cdec").alias("provider"), F.lit("flow").alias("param"), raw.alias("raw_unit"))
    return C.infer_unit(d, C.unit_aliases(spark, [("odd", "cfs", "special")])).select("o_orderkey", "unit")


@query("cat14_enrich_meta", f"WITH {FILES}, {REG} SELECT n.file, n.station_id, r.station_name, r.agency, r.x, r.y, 'cfs' AS unit, r.station_id IS NOT NULL AS registered FROM named n LEFT JOIN reg r USING (station_id)")
def _(spark, sf):
    p = parsed(spark, sf).select("file", "station_id", "agency_id", "param")
    units = registry(spark, sf).select("station_id", F.lit("flow").alias("param"), F.lit("cfs").alias("unit"))
    good, lost = C.enrich_meta(p, registry(spark, sf), units)
    g = good.select("file", "station_id", "station_name", "agency", "x", "y", "unit", F.lit(True).alias("registered"))
    n = lambda t: F.lit(None).cast(t)
    return g.unionByName(lost.select("file", "station_id", n("string").alias("station_name"), n("string").alias("agency"), n("double").alias("x"), n("double").alias("y"), F.lit("cfs").alias("unit"), F.lit(False).alias("registered")))


@query("cat15_resolve_sentinels", f"""WITH {FILES}, {REG} SELECT n.file, CASE WHEN o_custkey % 3 = 0 THEN 'x' || n.agency_id ELSE n.station_id END AS station_id, 'flow' AS param, CASE WHEN o_custkey % 3 = 0 THEN 'usbr' ELSE r.agency END AS agency
FROM named n JOIN reg r USING (station_id)""")
def _(spark, sf):
    p = file_names(spark, sf).select("o_custkey", "file", N.parse_name("file").alias("parsed")).filter("o_custkey % 300 % 30 <> 0")
    c = F.col("o_custkey") % 3
    d = p.select("file", "parsed", F.col("parsed.agency_id").alias("agency_id"),
                 F.when(c == 0, F.concat(F.lit("x"), "parsed.agency_id")).when(c == 1, "infer_from_agency_id").otherwise("infer_from_filename").alias("station_id"),
                 F.lit("infer_from_filename").alias("param"), F.when(c == 0, "usbr").otherwise("registry_lookup").alias("agency"))
    return C.resolve_meta_sentinels(d, registry(spark, sf), ["param", "agency"]).select("file", "station_id", "param", "agency")


@query("cat16_check_meta", """WITH m AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN 'usgs' END AS source, CASE WHEN c_custkey % 7 = 0 THEN 'FLOW' ELSE 'flow' END AS param, CASE WHEN c_custkey % 11 = 0 THEN 'Mars' ELSE 'Etc/GMT+8' END AS z, c_custkey % 13 = 0 AS far FROM customer)
SELECT c_custkey, 'missing_source' AS problem FROM m WHERE source IS NULL UNION ALL SELECT c_custkey, 'not_lower_param' FROM m WHERE param = 'FLOW' UNION ALL SELECT c_custkey, 'bad_time_zone' FROM m WHERE z = 'Mars' UNION ALL SELECT c_custkey, 'no_coordinates' FROM m WHERE far""")
def _(spark, sf):
    k = F.col("c_custkey")
    d = table(spark, sf, "customer").select("c_custkey", F.lit("st").alias("station_id"), F.when(k % 5 != 0, "usgs").alias("source"), F.lit("usbr").alias("agency"), F.when(k % 7 == 0, "FLOW").otherwise("flow").alias("param"),
                                            F.lit("ft").alias("unit"), F.when(k % 11 == 0, "Mars").otherwise("Etc/GMT+8").alias("time_zone"), F.when(k % 13 == 0, -9999.0).otherwise(38.0).alias("latitude"), F.lit(-121.0).alias("longitude"))
    return C.meta_problems(d, ["Etc/GMT+8", "America/Los_Angeles"], key="c_custkey")


@query("cat17_year_metadata", f"""WITH m AS (SELECT o_custkey, year(o_orderdate) AS y, 'f' || month(o_orderdate) AS file, 'h' || month(o_orderdate) AS header FROM orders WHERE o_orderstatus <> 'P')
SELECT o_custkey, CAST(y AS INT) AS year, arg_max(header, file) AS header, max(file) AS last_file FROM m GROUP BY ALL""")
def _(spark, sf):
    m = F.month("o_orderdate").cast("string")
    d = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("ts"), F.concat(F.lit("f"), m).alias("file"), F.concat(F.lit("h"), m).alias("header"), F.when(F.col("o_orderstatus") != "P", 1.0).alias("value"))
    return C.year_metadata(d, ["o_custkey"], "header")


# --- requests ----------------------------------------------------------------


def requests(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(F.concat(F.lit(" S"), (k % 320).cast("string"), F.when(k % 3 == 0, "@Upper").otherwise("")).alias("station_id"), F.when(k % 4 == 0, "Default").when(k % 5 == 0, "Mid").alias("subloc"), F.when(k % 2 == 0, "Elev").alias("param"), k.alias("n"))


REQ = """req AS (SELECT c_custkey AS n, 's' || (c_custkey % 320) AS station_id, CASE WHEN c_custkey % 3 = 0 THEN 'upper' WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'mid' END AS subloc, CASE WHEN c_custkey % 2 = 0 THEN 'elev' ELSE 'flow' END AS param FROM customer)"""


def norm(spark, sf):
    return RQ.normalize_request(requests(spark, sf), "flow")


@query("join1_normalize_request", f"WITH {REQ} SELECT * FROM req")
def _(spark, sf):
    return norm(spark, sf)


@query("join2_attach_agency_id", f"WITH {REQ}, {REG} SELECT req.*, agency_id FROM req JOIN reg USING (station_id)")
def _(spark, sf):
    return RQ.attach_agency_id(norm(spark, sf), registry(spark, sf), "drop")


def sublocs(spark, sf):
    n = table(spark, sf, "customer").filter("c_custkey % 3 <> 2")  # the others have no sublocation
    a = n.select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("station_id"), F.lit("upper").alias("subloc"), F.lit(-1.0).alias("z"))
    b = n.filter("c_custkey % 2 = 0").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("station_id"), F.lit("lower").alias("subloc"), F.lit(-5.0).alias("z"))
    return a.unionByName(b)


SUB = "sub AS (SELECT 's' || c_custkey AS station_id, 'upper' AS subloc, -1.0::DOUBLE AS z FROM customer WHERE c_custkey % 3 <> 2 UNION ALL SELECT 's' || c_custkey, 'lower', -5.0::DOUBLE FROM customer WHERE c_custkey % 3 <> 2 AND c_custkey % 2 = 0)"


@query("join3_attach_subloc", f"WITH {REQ}, {SUB} SELECT DISTINCT req.n, req.station_id, req.param, coalesce(req.subloc, sub.subloc, 'default') AS subloc FROM req LEFT JOIN sub ON req.station_id = sub.station_id AND req.subloc IS NULL")
def _(spark, sf):
    return RQ.attach_subloc(norm(spark, sf), sublocs(spark, sf))


def mapping(spark):
    return spark.createDataFrame([("flow", "usgs", "00060"), ("flow", "usgs", "72137"), ("flow", "cdec", "20"), ("elev", "cdec", "1")], "var_name string, src_name string, src_var_id string")


@query("join4_attach_src_var_id", f"WITH {REQ}, m(param, src_var_id) AS (VALUES ('flow', '00060'), ('flow', '72137')) SELECT req.*, coalesce(m.src_var_id, req.param) AS src_var_id FROM req LEFT JOIN m USING (param)")
def _(spark, sf):
    return RQ.attach_src_var_id(norm(spark, sf), mapping(spark), "usgs")


@query("join5_merge_station_subloc", f"WITH {REG}, {SUB} SELECT reg.station_id, coalesce(sub.subloc, 'default') AS subloc, coalesce(z, -0.5)::DOUBLE AS z FROM reg LEFT JOIN sub USING (station_id)")
def _(spark, sf):
    return RQ.merge_station_subloc(registry(spark, sf).select("station_id"), sublocs(spark, sf))


def trace_inventory(spark, sf):
    o = table(spark, sf, "orders")
    site = F.concat(F.lit("B"), (F.col("o_custkey") % 400).cast("string"), F.when(F.col("o_custkey") % 3 == 0, "Q").when(F.col("o_custkey") % 3 == 1, "00").otherwise(""))
    return o.groupBy(site.alias("site"), F.when(F.col("o_orderstatus") == "F", "flow").otherwise("elev").alias("param")).agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))


_TI = """ti AS (SELECT 'B' || (o_custkey % 400) || CASE o_custkey % 3 WHEN 0 THEN 'Q' WHEN 1 THEN '00' ELSE '' END AS site, CASE WHEN o_orderstatus = 'F' THEN 'flow' ELSE 'elev' END AS param, min(o_orderdate) AS start, max(o_orderdate) AS "end" FROM orders GROUP BY ALL),
rq AS (SELECT 'B' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN 'Q' ELSE '' END AS station_id, 'flow' AS param, TIMESTAMP '1996-06-01' AS req_start, TIMESTAMP '1996-09-01' AS req_end FROM customer)"""


@query("join6_inventory_overlap", f"""WITH {_TI}, b AS (SELECT *, regexp_replace(station_id, '(Q|00)$', '') AS base FROM rq), al AS (SELECT *, unnest([base, base || 'Q', base || '00']) AS site FROM b)
SELECT station_id, site, ti.param, start, "end" FROM al JOIN ti USING (site, param) WHERE start <= req_end AND "end" >= req_start""")
def _(spark, sf):
    k = F.col("c_custkey")
    rq = table(spark, sf, "customer").select(F.concat(F.lit("B"), k.cast("string"), F.when(k % 2 == 0, "Q").otherwise("")).alias("station_id"), F.lit("flow").alias("param"),
                                                                      ntz("1996-06-01 00:00:00").alias("req_start"), ntz("1996-09-01 00:00:00").alias("req_end"))
    return RQ.inventory_overlap(rq, trace_inventory(spark, sf)).select("station_id", "site", "param", "start", "end")


@query("join7_site_aliases", "SELECT c_custkey, unnest([b, b || 'Q', b || '00']) AS alias FROM (SELECT c_custkey, regexp_replace('B' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN 'Q' ELSE '' END, '(Q|00)$', '') AS b FROM customer)")
def _(spark, sf):
    k = F.col("c_custkey")
    st = F.concat(F.lit("b"), k.cast("string"), F.when(k % 2 == 0, "q").otherwise(""))
    return table(spark, sf, "customer").select("c_custkey", F.explode(RQ.site_aliases(st)).alias("alias"))


@query("prd18_build_request", f"""WITH {REG}, {SUB}, {FILES} SELECT r.station_id, coalesce(s.subloc, 'default') AS subloc, 'flow' AS param, coalesce(z, -0.5)::DOUBLE AS z, agency_id, m.v AS src_var_id, station_name
FROM reg r LEFT JOIN sub s USING (station_id) CROSS JOIN (VALUES ('00060'), ('72137')) m(v) WHERE agency = 'usgs' AND r.station_id NOT IN (SELECT station_id FROM named WHERE source = 'cdec')""")
def _(spark, sf):
    held = parsed(spark, sf).filter("source = 'cdec'").select("station_id", "param")
    return RQ.build_request(registry(spark, sf), sublocs(spark, sf), mapping(spark), "usgs", "flow", held, "usgs")


@query("udf1_register_transform", f"WITH {OBS} SELECT station, param, ts, value * 3 AS value FROM obs")
def _(spark, sf):
    if "triple" not in ST._STEPS:
        ST.register_transform("triple", lambda df, factor: df.withColumn("value", F.col("value") * factor))
    return ST.apply_transform(obs(spark, sf).drop("seq"), "triple", {"factor": 3})


@query("prd17_select_steps", f"WITH {OBS} SELECT station, count(*) AS n FROM obs WHERE station NOT IN ('view') GROUP BY station")
def _(spark, sf):
    return ST.select_rows(obs(spark, sf), "station", exclude=["view"]).groupBy("station").agg(F.count(F.lit(1)).alias("n"))
