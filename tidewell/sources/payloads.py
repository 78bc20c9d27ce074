"""SRC-10..13.  Provider JSON payloads, one per row, to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

USGS_SCHEMA = """value struct<timeSeries: array<struct<
  sourceInfo: struct<siteCode: array<struct<value: string>>, timeZoneInfo: struct<defaultTimeZone: struct<zoneOffset: string>>>,
  variable: struct<variableCode: array<struct<value: string>>>,
  values: array<struct<method: array<struct<methodID: bigint, methodDescription: string>>,
                       value: array<struct<value: string, dateTime: string, qualifiers: array<string>>>>>>>>"""
DAILY_SCHEMA = "features array<struct<properties: struct<time: string, value: string>>>"
TRACE_SCHEMA = "`return` struct<traces: array<struct<site: string, trace: array<struct<t: string, v: string, q: string>>>>>"
INVENTORY_SCHEMA = "`return` struct<sites: array<struct<site: string, traces: array<struct<trace: string, start_time: string, end_time: string>>>>>"


def _one(arr: Column, what: str) -> Column:
    """The only element; more than one is an error."""
    return F.when(F.size(arr) > 1, F.raise_error(F.lit(f"more than one {what}")).cast("string")).otherwise(F.lit("ok"))


def offset_seconds(text: Column) -> Column:
    """``-08:00`` to seconds."""
    sign = F.when(text.startswith("-"), -1).otherwise(1)
    part = lambda i: F.regexp_extract(text, r"^[+-]?(\d{2}):(\d{2})$", i).try_cast("int")
    return sign * (part(1) * 3600 + part(2) * 60)


def flatten_usgs_json(df: DataFrame, payload="payload") -> DataFrame:
    """SRC-10.  (site, var, ts_id, method, ts, value, qualifiers).  Times move to
    the default offset of the station; qualifiers are joined by commas."""
    s = df.select(F.explode(F.from_json(payload, USGS_SCHEMA)["value"]["timeSeries"]).alias("s"))
    v = s.select(F.col("s.sourceInfo.siteCode")[0]["value"].alias("site"), F.col("s.variable.variableCode")[0]["value"].alias("var"),
                 F.col("s.sourceInfo.timeZoneInfo.defaultTimeZone.zoneOffset").alias("off"), F.posexplode("s.values").alias("vi", "b"))
    m = F.col("b.method")[0]
    v = v.select("site", "var", "off",
                 F.coalesce(m["methodID"].cast("string"), F.concat(F.lit("unknown_"), F.col("vi").cast("string"))).alias("ts_id"),
                 F.coalesce(m["methodDescription"], F.lit("Unknown method description")).alias("method"), F.explode("b.value").alias("p"))
    moment = F.to_timestamp(F.regexp_replace(F.col("p.dateTime"), r"^(.{10}).", "$1T"))
    us = F.unix_micros(moment) + offset_seconds(F.col("off")).cast("long") * 1_000_000
    return v.select("site", "var", "ts_id", "method", F.timestamp_micros(us).cast("timestamp_ntz").alias("ts"),
                    F.col("p.value").try_cast("double").alias("value"), F.array_join("p.qualifiers", ",").alias("qualifiers"))


def flatten_usgs_daily_json(df: DataFrame, payload="payload", keep=()) -> DataFrame:
    """SRC-11.  (ts, value); features without a time dropped, bad numbers NULL."""
    f = df.select(*keep, F.explode(F.from_json(payload, DAILY_SCHEMA)["features"]).alias("f"))
    t = F.col("f.properties.time")
    return f.filter(t.isNotNull() & (t != "")).select(*keep, F.to_timestamp_ntz(t).alias("ts"), F.col("f.properties.value").try_cast("double").alias("value"))


def flatten_trace_json(df: DataFrame, payload="payload", keep=()) -> DataFrame:
    """SRC-12.  (site, ts, value, quality); more than one trace is an error."""
    r = df.select(*keep, F.from_json(payload, TRACE_SCHEMA)["return"]["traces"].alias("t"))
    r = r.filter(_one(F.col("t"), "trace") == "ok")
    p = r.select(*keep, F.col("t")[0]["site"].alias("site"), F.explode(F.col("t")[0]["trace"]).alias("p"))
    return p.select(*keep, "site", F.to_timestamp("p.t", "yyyyMMddHHmmss").cast("timestamp_ntz").alias("ts"),
                    F.col("p.v").try_cast("double").alias("value"), F.col("p.q").alias("quality"))


def flatten_inventory_json(df: DataFrame, payload="payload") -> DataFrame:
    """SRC-13.  (site, trace, start, end) of traces that end in RAW; null sites skipped."""
    s = df.select(F.explode(F.from_json(payload, INVENTORY_SCHEMA)["return"]["sites"]).alias("s")).filter("s.site IS NOT NULL")
    t = s.select(F.col("s.site").alias("site"), F.explode("s.traces").alias("t")).filter(F.col("t.trace").endswith("RAW"))
    return t.select("site", "t.trace", F.to_timestamp_ntz("t.start_time").alias("start"), F.to_timestamp_ntz("t.end_time").alias("end")).dropDuplicates()
