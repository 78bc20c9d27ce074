"""Input roles on the given tables, in Spark and as SQL for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.operators.chunks import plan_chunk
from tidewell.operators.grid import complete, index_time
from tidewell.schema import MICROS, micros
from tidewell.session import prepare

K = ["station", "param"]
QUERIES: dict = {}
ORACLE: dict[str, str] = {}
_WIDTH: dict[tuple, int] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def width(spark, sf) -> int:
    """Chunk width measured once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WIDTH:
        _WIDTH[key] = plan_chunk(table(spark, sf, "events").select("ts"))
    return _WIDTH[key]


def obs(spark, sf) -> DataFrame:
    """Irregular observations of 15 series; values above 150 are missing."""
    e = table(spark, sf, "events")
    return e.select(F.col("event_type").alias("station"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("param"),
                    "ts", F.col("event_id").alias("seq"), F.when(F.col("value") <= 150, F.col("value")).alias("value"))


OBS = """obs AS (SELECT event_type AS station, 'p' || (user_id % 3) AS param, ts, event_id AS seq,
  CASE WHEN value <= 150 THEN value END AS value FROM events)"""


def hourly_rows(spark, sf) -> DataFrame:
    return obs(spark, sf).groupBy(*K, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("value"))


def hourly(spark, sf) -> DataFrame:
    """Hourly maximum on the complete grid of each series, gaps as NULL."""
    i = F.floor(micros("ts") / F.lit(3600 * MICROS).cast("long")).alias("__i")
    h = obs(spark, sf).groupBy(*K, i).agg(F.max("value").alias("value"))
    return complete(h, K, "__i", ["value"]).select(*K, index_time("__i", 3600).alias("ts"), "value")


HB = OBS + """, hb AS (SELECT station, param, date_trunc('hour', ts) AS ts, max(value) AS value FROM obs GROUP BY ALL)"""
HOURLY = HB + """, span AS (SELECT station, param, min(ts) AS a, max(ts) AS b FROM hb GROUP BY ALL),
grid AS (SELECT station, param, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM span),
hourly AS (SELECT g.station, g.param, g.ts, h.value FROM grid g LEFT JOIN hb h USING (station, param, ts))"""


def daily(spark, sf) -> DataFrame:
    """Daily sums of seven years, five series."""
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("station"), F.lit("price").alias("param"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))


DAILY = """daily AS (SELECT o_orderpriority AS station, 'price' AS param, o_orderdate AS ts, round(sum(o_totalprice), 2) AS value
  FROM orders GROUP BY ALL)"""


def part_of(df: DataFrame, k: int, n: int = 3) -> DataFrame:
    return df.filter(F.col("seq") % n == k)


W = "PARTITION BY station, param ORDER BY ts, seq"
WH = "PARTITION BY station, param ORDER BY ts"
UP = "ROWS BETWEEN UNBOUNDED PRECEDING AND"


def r6(c):
    return F.round(c, 6)
