"""FN queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import query, r6, table
from tidewell.functions import scalars as S
from tidewell.schema import ntz


def li(spark, sf, *cols):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)


def _pick(texts, key="l_orderkey"):
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col(key) % len(texts) + 1).cast("int"))


def _case(texts, key="l_orderkey"):
    q = lambda t: "'" + t.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '") + "'"
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(texts)) + " END"


def _mapped(out, key="l_orderkey"):
    lit = lambda t: "NULL" if t is None else (str(t) if isinstance(t, (int, float)) else "'" + t.replace("'", "''") + "'")
    return f"CASE {key} % {len(out)} " + " ".join(f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(out)) + " END"


@query("fn1_fahrenheit_to_celsius", "SELECT l_orderkey, l_linenumber, round((l_quantity - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE, 2) AS value FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.fahrenheit_to_celsius("l_quantity").alias("value"))


_PAIRS = [("ft^3/s", "m^3/s"), ("ft", "m"), ("deg_f", "deg_c"), ("deg_c", "deg_f"), ("m", "m")]


@query("fn2_convert_units", """SELECT l_orderkey, l_linenumber, round(CASE l_orderkey % 5 WHEN 0 THEN l_quantity * 0.028316846592::DOUBLE WHEN 1 THEN l_quantity * 0.3048::DOUBLE WHEN 2 THEN (l_quantity - 32) * 5.0::DOUBLE / 9.0::DOUBLE
 WHEN 3 THEN l_quantity * 1.8::DOUBLE + 32 ELSE l_quantity END, 6) AS value FROM lineitem""")
def _(spark, sf):
    return li(spark, sf, r6(S.convert_units("l_quantity", _pick([a for a, _ in _PAIRS]), _pick([b for _, b in _PAIRS]))).alias("value"))


_UNITS = ["FNU", "NTU", "uS/cm", "cfs", "deg_f", "mg/l"]


@query("fn3_canonical_unit", f"SELECT l_orderkey, l_linenumber, {_mapped(['FNU', 'FNU', 'microS/cm', 'ft^3/s', 'deg_c', 'mg/l'])} AS unit, CASE WHEN l_orderkey % 6 = 4 THEN round((l_quantity - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE, 2) ELSE l_quantity END AS value FROM lineitem")
def _(spark, sf):
    u = _pick(_UNITS)
    return li(spark, sf, S.canonical_unit(u).alias("unit"), S.canonical_value("l_quantity", u).alias("value"))


@query("fn4_linear", "SELECT l_orderkey, l_linenumber, l_quantity * 2.5::DOUBLE + 1.25::DOUBLE AS value FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.linear("l_quantity", 2.5, 1.25).alias("value"))


def _p(c):
    return f"({c[0]} + s * ({c[1]} + s * ({c[2]} + s * ({c[3]} + s * ({c[4]} + s * ({c[5]}))))))"


@query("fn5_ec_to_psu", f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 53087.0::DOUBLE AS r, sqrt(l_extendedprice / 53087.0::DOUBLE) AS s, 10.0::DOUBLE / 1.162::DOUBLE AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, round({_p((0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081))} + t * {_p((0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144))}
 - 0.008 / (1 + 600 * r + 160000 * r * r) - 0.0005 * t / (1 + sqrt(100 * r) + 100 * r + 100 * r * sqrt(100 * r)), 6) AS psu FROM r""")
def _(spark, sf):
    return li(spark, sf, r6(S.ec_to_psu_25c("l_extendedprice")).alias("psu"))


@query("fn6_add_column", "SELECT l_orderkey, l_linenumber, 1.5::DOUBLE AS extra FROM lineitem")
def _(spark, sf):
    return S.add_column(li(spark, sf), "extra", 1.5, "double")


@query("fn7_datum_adjust", "SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate <= TIMESTAMP '1998-06-01' THEN l_quantity + 2.5::DOUBLE ELSE l_quantity END AS value FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.datum_adjust("l_quantity", "l_shipdate", 2.5, "1998-06-01 00:00:00").alias("value"))


@query("fn8_depth_class", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity / 10 - 2 < 0 THEN 'air' WHEN l_quantity / 10 - 2 <= 1 THEN 'upper' ELSE 'lower' END AS subloc FROM lineitem")
def _(spark, sf):
    text = F.concat(F.lit("Sensor depth = "), (F.col("l_quantity") / 10 - 2).cast("decimal(10,2)").cast("string"), F.lit(" m"))
    return li(spark, sf, S.depth_class(text).alias("subloc"))


_GATES = ["O", "open", " C ", "CLSD", "Closed", "OP", "M-OP", "tidal", "Removed"]


@query("fn9_gate_state", f"SELECT l_orderkey, l_linenumber, {_mapped(['Open', 'Open', 'Closed', 'Closed', 'Closed', 'Tidal', 'Tidal', 'Tidal', 'Removed'])} AS state FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.normalize_gate_state(_pick(_GATES)).alias("state"))


_ACTIONS = ["Partially Opened", "CLOSE gates", "opened", "-", "closed"]


@query("fn10_action", f"SELECT l_orderkey, l_linenumber, {_mapped(['partially open', 'closed', 'open', 'no action', 'closed'])} AS action FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.normalize_action(_pick(_ACTIONS)).alias("action"))


@query("fn11_parse_any_datetime", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 IN (0, 1, 2) THEN o_orderdate + INTERVAL 9 HOUR + INTERVAL 5 MINUTE ELSE o_orderdate END AS ts FROM orders""")
def _(spark, sf):
    d = table(spark, sf, "orders")
    t = F.col("o_orderdate") + F.expr("INTERVAL '09:05' HOUR TO MINUTE")
    f = lambda p: F.date_format(t, p)
    m = F.col("o_orderkey") % 5
    text = F.when(m == 0, f("M/d/yyyy H:mm")).when(m == 1, f("M/d/yy H:mm")).when(m == 2, f("yyyy-MM-dd HH:mm:ss")).when(m == 3, f("M/d/yyyy")).otherwise("no date")
    return d.select("o_orderkey", S.parse_any_datetime(text).alias("ts"))


@query("fn12_append_note", f"SELECT l_orderkey, l_linenumber, {_mapped(['gate 2', 'see gate 3', 'gate 1 late', 'late'])} AS note FROM lineitem")
def _(spark, sf):
    return li(spark, sf, S.append_note(_pick(["-", "see gate 3", "late", "late"]), _pick(["Gate 2 opened", "gate 3", "GATE 1", "all"])).alias("note"))


@query("fn13_one_line", "SELECT doc_id, length(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS n, md5(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS digest FROM documents")
def _(spark, sf):
    t = S.one_line("text")
    return table(spark, sf, "documents").select("doc_id", F.length(t).cast("long").alias("n"), F.md5(t).alias("digest"))


@query("fn14_clean_number", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS value FROM lineitem")
def _(spark, sf):
    text = F.concat(F.lit("00"), F.format_number("l_extendedprice", 2), F.lit(" CFS"))
    return li(spark, sf, S.clean_number(F.when(F.col("l_linenumber") == 7, "n/a").otherwise(text)).alias("value"))


@query("fn15_station_kind", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'tidecurrent' ELSE 'buoy' END AS kind FROM orders")
def _(spark, sf):
    st = F.when(F.col("o_orderkey") % 3 == 0, F.lpad(F.col("o_orderkey").cast("string"), 7, "9")).otherwise(F.concat(F.lit("b"), F.col("o_orderkey").cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", S.station_kind(st).alias("kind"))


@query("fn16_clip_interval", """SELECT o_orderkey, greatest(o_orderdate, TIMESTAMP '1996-01-01') AS a, least(CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2000-01-01' ELSE o_orderdate + INTERVAL 90 DAY END, TIMESTAMP '1999-06-30') AS b FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("e", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")))
    a, b = S.clip_interval("o_orderdate", "e", ntz("1996-01-01 00:00:00"), ntz("1999-06-30 00:00:00"), ntz("2000-01-01 00:00:00"))
    return o.select("o_orderkey", a.alias("a"), b.alias("b"))


@query("fn17_normalize_columns", "SELECT l_orderkey AS key, l_quantity AS value, CAST(NULL AS VARCHAR) AS remarks, l_shipmode_x AS ship_date FROM (SELECT *, l_shipdate AS l_shipmode_x FROM lineitem)")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("KEY"), F.col("l_quantity").alias(" VALUE "), F.col("l_shipdate").alias("Ship Date"), "l_tax")
    return S.normalize_column_names(S.single_value_column(d), ["key", "value", "remarks", "ship_date"])


@query("fn18_map_param", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'flow' WHEN 1 THEN 'elev' END AS param FROM orders WHERE o_orderkey % 4 < 2")
def _(spark, sf):
    m = spark.createDataFrame([("Discharge", "flow"), ("Stage", "elev"), ("Battery", None)], "src_name string, param string")
    d = table(spark, sf, "orders").withColumn("src_param", _pick(["Discharge", "Stage", "Battery", " "], "o_orderkey"))
    return S.map_param(d, m).select("o_orderkey", "param")
