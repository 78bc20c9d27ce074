"""MRG-6 with a policy: providers of different steps in one plan; SCR-11 end to end; PRD-14 grouped."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import HOURLY, K, UP, hourly, query, r6, table, width
from checks.base import OBS, obs
from checks.q_screen import CONFIG, _BY_SERIES, _SP1, inventory
from tidewell.operators.grid import complete, grid_index, index_time
from tidewell.plans import catalog as C, products as P, screening as SC, series as SE
from tidewell.schema import ntz
from tidewell.session import scratch
from tidewell.sources import shards as SH

NAMES = ["ncro", "cdec", "usgs"]


def stepped_providers(spark, sf):
    """Hourly, three-hourly and two-hourly providers of a series; series p1 has the
    first alone, series p0 has no second one."""
    h, ts, hour = hourly(spark, sf), F.col("ts"), F.hour("ts")
    inside = [ts < ntz("2024-01-12 00:00:00"),
              (ts >= ntz("2024-01-06 00:00:00")) & (ts < ntz("2024-01-20 00:00:00")) & (hour % 3 == 0) & (F.col("param") == "p2"),
              (ts >= ntz("2024-01-15 00:00:00")) & (hour % 2 == 0) & (F.col("param") != "p1")]
    return h.withColumn("provider", F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in zip(inside, NAMES, strict=True)]), lambda x: x.isNotNull()))).withColumn(
        "shard", F.weekofyear("ts").cast("string"))


STEPPED = HOURLY + """, parts AS (SELECT station, param, 0 AS p, ts, value FROM hourly WHERE ts < TIMESTAMP '2024-01-12'
 UNION ALL SELECT station, param, 1, ts, value FROM hourly WHERE ts >= TIMESTAMP '2024-01-06' AND ts < TIMESTAMP '2024-01-20' AND hour(ts) % 3 = 0 AND param = 'p2'
 UNION ALL SELECT station, param, 2, ts, value FROM hourly WHERE ts >= TIMESTAMP '2024-01-15' AND hour(ts) % 2 = 0 AND param <> 'p1')"""


def order(spark, sf):
    reg = table(spark, sf, "events").select(F.col("event_type").alias("station")).distinct().withColumn("agency", F.lit("ncro"))
    return C.provider_order(stepped_providers(spark, sf), reg, C.priority_table(spark, {"ncro": NAMES}))


def resolved_sql(policy: str) -> str:
    """The parts on their common step, as table `res` (station, param, p, ts, value)."""
    method, target = policy.split(":") if ":" in policy else ("interp" if policy.startswith("interp") else "asfreq", policy.rsplit("_", 1)[1])
    steps = {"finer": (3600, 3600), "coarser": (10800, 7200), "latest": (7200, 7200)}.get(target, (target, target))
    base = f"""{STEPPED}, tgt AS (SELECT *, CAST(CASE param WHEN 'p2' THEN {steps[0]} ELSE {steps[1]} END AS BIGINT) * 1000000 AS step, epoch_us(ts) AS us FROM parts WHERE param <> 'p1'),
sp AS (SELECT station, param, p, step, min(us) AS a, max(us) AS b FROM tgt GROUP BY ALL)"""
    if method == "asfreq":
        return base + """, g AS (SELECT station, param, p, unnest(generate_series(a, b, step)) AS us FROM sp),
res AS (SELECT g.station, g.param, g.p, make_timestamp(g.us) AS ts, t.value FROM g LEFT JOIN tgt t USING (station, param, p, us) UNION ALL SELECT * FROM parts WHERE param = 'p1')"""
    part = "PARTITION BY station, param, p ORDER BY us"
    down = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    return base + f""", g AS (SELECT station, param, p, unnest(generate_series(a // step * step, (b + step - 1) // step * step, step)) AS us FROM sp),
dec AS (SELECT station, param, p, CAST(least(floor(median(length(rtrim(split_part(CAST(CAST(value AS DECIMAL(38, 10)) AS VARCHAR), '.', 2), '0')))), 4) AS INTEGER) AS d FROM tgt WHERE value IS NOT NULL GROUP BY ALL),
u AS (SELECT station, param, p, us, max(value) AS value, max(g) AS g FROM (SELECT station, param, p, us, value, 0 AS g FROM tgt WHERE value IS NOT NULL UNION ALL SELECT station, param, p, us, NULL, 1 FROM g) GROUP BY ALL),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER ({part} {UP} 1 PRECEDING) AS v0, last_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER ({part} {UP} 1 PRECEDING) AS t0,
 first_value(value IGNORE NULLS) OVER ({part} {down}) AS v1, first_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER ({part} {down}) AS t1 FROM u),
res AS (SELECT station, param, p, make_timestamp(us) AS ts, round(coalesce(value, v0 + (v1 - v0) * (us - t0) / (t1 - t0), v0) * power(10, d)) / power(10, d) AS value FROM f JOIN dec USING (station, param, p) WHERE g = 1
 UNION ALL SELECT * FROM parts WHERE param = 'p1')"""


SPLICED = """, en AS (SELECT station, param, max(ts) FILTER (p = 0 AND value IS NOT NULL) AS e0, max(ts) FILTER (p = 1 AND value IS NOT NULL) AS e1, max(ts) FILTER (p = 2 AND value IS NOT NULL) AS e2 FROM res GROUP BY ALL),
spl AS (SELECT res.station, res.param, res.ts, res.value FROM res JOIN en USING (station, param)
 WHERE (p = 0 AND (ts <= e0 OR (e1 IS NULL AND e2 IS NULL))) OR (p = 1 AND ts > e0 AND (ts <= greatest(e0, e1) OR e2 IS NULL)) OR (p = 2 AND ts > greatest(e0, coalesce(e1, e0))))"""


def _policy_query(policy: str) -> None:
    @query(f"mrg6_read_series_{policy.replace(':', '_')}", f"WITH {resolved_sql(policy)} {SPLICED} SELECT station, param, ts, round(value, 6) AS value FROM spl")
    def _(spark, sf):
        d = SE.read_series(stepped_providers(spark, sf), K, order(spark, sf), 3, policy=policy, seconds=width(spark, sf))
        return d.withColumn("value", r6(F.col("value")))


for _policy in ("interp_to_finer", "interp_to_coarser", "interp_to_latest", "as_freq_finer", "as_freq_coarser", "as_freq_latest", "interp:5400", "asfreq:21600"):
    _policy_query(_policy)


@query("mrg6_collect_failures", f"""WITH {STEPPED} SELECT station, param, CASE WHEN station = 'view' THEN 'shards overlap in time' ELSE 'mixed frequencies of which one is irregular' END AS problem
FROM parts WHERE (station = 'view' AND param = 'p2') OR (station = 'click' AND param = 'p0') GROUP BY station, param""")
def _(spark, sf):
    return SE.collect_series(troubled(spark, sf), K, order(spark, sf), 3, policy="as_freq_finer", seconds=width(spark, sf))[1]


@query("mrg6_collect_series", f"WITH {resolved_sql('as_freq_finer')} {SPLICED} SELECT station, param, ts, value FROM spl WHERE NOT (station = 'view' AND param = 'p2') AND NOT (station = 'click' AND param = 'p0')")
def _(spark, sf):
    return SE.collect_series(troubled(spark, sf), K, order(spark, sf), 3, policy="as_freq_finer", seconds=width(spark, sf))[0]


def troubled(spark, sf):
    """One series with overlapping shards, one with a provider of no step."""
    d = stepped_providers(spark, sf)
    view = (F.col("station") == "view") & (F.col("param") == "p2") & (F.dayofmonth("ts") % 2 == 0)
    ragged = (F.col("station") == "click") & (F.col("param") == "p0") & (F.col("provider") == "usgs") & ((F.hour("ts") + F.dayofmonth("ts")) % 6 == 0)
    return d.withColumn("shard", F.when(view, F.lit("all")).otherwise(F.col("shard"))).filter(~ragged)


@query("mrg6_first_headers", f"WITH {STEPPED} SELECT station, param, p, min(weekofyear(ts)) AS week FROM parts GROUP BY ALL")
def _(spark, sf):
    d = stepped_providers(spark, sf)
    meta = d.select(*K, "provider", F.format_string("%03d.csv", F.weekofyear("ts")).alias("file"), F.struct(F.weekofyear("ts").cast("long").alias("week")).alias("header")).distinct()
    h = SE.first_headers(meta, K)
    return h.select(*K, F.expr("CASE provider WHEN 'ncro' THEN 0 WHEN 'cdec' THEN 1 ELSE 2 END").alias("p"), F.col("header.week").alias("week"))


# --- SCR-11 from read to write ------------------------------------------------

BROKEN = {**CONFIG, "stations": {**CONFIG["stations"],
          "error": {"params": {"p2": {"inherits_global": True, "add_steps": [{"method": "wavelet_test"}]}}},
          "purchase": {"params": {"p1": {"inherits_global": True, "modify_steps": [{"method": "bounds_test", "args": {"bounds": [1.0]}}]}}}}}
_BAD = """(VALUES ('error', 'p2', 'unknown method wavelet_test'), ('purchase', 'p1', 'bounds_test: bounds must hold 2 numbers'), ('ghost', 'p9', 'no data found'),
 ('view', 'p2', 'shards overlap in time'), ('click', 'p0', 'mixed frequencies of which one is irregular')) bad(station, param, problem)"""


def repository(spark, sf, path=None):
    listed = inventory(spark, sf).unionByName(spark.createDataFrame([("ghost", "p9", "default")], "station string, param string, region string"))
    return SC.screen_repository(troubled(spark, sf), order(spark, sf), 3, BROKEN, listed, path=path, seconds=width(spark, sf))


@query("scr11_repository_failures", f"WITH {OBS}, known AS (SELECT DISTINCT station, param FROM obs UNION SELECT 'ghost', 'p9') SELECT station, param, problem FROM {_BAD} JOIN known USING (station, param)")
def _(spark, sf):
    return repository(spark, sf)[1]


@query("scr11_screen_repository", f"""WITH {resolved_sql('as_freq_finer')} {SPLICED}, src AS (SELECT * FROM spl WHERE (station, param) NOT IN (SELECT (station, param) FROM {_BAD}))
 {_BY_SERIES[len(HOURLY):].replace('FROM hourly', 'FROM src')}, fl AS (SELECT station, param, ts, value, CASE WHEN bounds_test OR (short_run_test AND NOT {_SP1}) OR (repeat_test AND NOT {_SP1} AND NOT (station = 'view' AND param = 'p2'))
 OR (median_test_twoside AND param <> 'p1') THEN CAST(1 AS TINYINT) END AS user_flag FROM scr)
SELECT * FROM fl WHERE (station, param, year(ts)) IN (SELECT (station, param, year(ts)) FROM fl GROUP BY station, param, year(ts) HAVING count(value) >= 16)""")
def _(spark, sf):
    root = scratch(spark, "screened")
    repository(spark, sf, root)
    return SH.read_shards(spark, root).select(*K, "ts", "value", "user_flag")


# --- PRD-14 grouped -----------------------------------------------------------

def grouped_files(spark, sf):
    """Files of each series, with steps that change: hourly then quarter-hourly (p1),
    hourly and daily (p2), hourly alone (p0).  The first file of a series has too few
    points; one series goes from hourly to two-hourly, for which there is no rule."""
    ts, day = F.col("ts"), F.dayofmonth("ts")
    h = hourly(spark, sf)
    quarter = obs(spark, sf).groupBy(*K, grid_index("ts", 900).alias("i")).agg(F.max("value").alias("value"))
    quarter = complete(quarter, K, "i", ["value"]).select(*K, index_time("i", 900).alias("ts"), "value")
    name = lambda d, f: d.select(*K, F.lit(f).alias("file"), "ts", "value")
    parts = [name(h.filter(day == 2).filter(F.hour("ts") < 12), "a_0"), name(h.filter(day < 12), "b_1"),
             name(quarter.filter((F.col("param") == "p1") & (ts >= ntz("2024-01-10 00:00:00")) & (ts < ntz("2024-01-21 00:00:00"))), "c_2"),
             name(h.filter((F.col("param") == "p2") & (F.col("station") != "view") & (day >= 9) & (F.hour("ts") == 0)), "d_3"),
             name(h.filter((F.col("param") == "p2") & (F.col("station") == "view") & (day >= 9) & (F.hour("ts") % 2 == 0)), "d_3"),
             name(h.filter((F.col("param") == "p0") & (day >= 11)), "e_4")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_GROUPED = HOURLY + """, q0 AS (SELECT station, param, CAST(round_even(epoch_us(ts)::DOUBLE / 900000000, 0) AS BIGINT) AS i, max(value) AS value FROM obs GROUP BY ALL),
qg AS (SELECT station, param, unnest(generate_series(min(i), max(i))) AS i FROM q0 GROUP BY station, param), quarter AS (SELECT g.station, g.param, make_timestamp(g.i * 900000000) AS ts, q0.value FROM qg g LEFT JOIN q0 USING (station, param, i)),
files AS (SELECT station, param, 'a_0' AS file, ts, value FROM hourly WHERE day(ts) = 2 AND hour(ts) < 12 UNION ALL SELECT station, param, 'b_1', ts, value FROM hourly WHERE day(ts) < 12
 UNION ALL SELECT station, param, 'c_2', ts, value FROM quarter WHERE param = 'p1' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'
 UNION ALL SELECT station, param, 'd_3', ts, value FROM hourly WHERE param = 'p2' AND day(ts) >= 9 AND ((station <> 'view' AND hour(ts) = 0) OR (station = 'view' AND hour(ts) % 2 = 0))
 UNION ALL SELECT station, param, 'e_4', ts, value FROM hourly WHERE param = 'p0' AND day(ts) >= 11),
enough AS (SELECT station, param, file FROM files GROUP BY ALL HAVING count(value) >= 15), used AS (SELECT * FROM files JOIN enough USING (station, param, file) WHERE NOT (station = 'view' AND param = 'p2') AND station <> 'error'),
bare AS (SELECT station, param, bool_or(file = 'd_3') AS daily, bool_or(file = 'c_2') AS fine FROM used GROUP BY ALL),
day1 AS (SELECT station, param, file, min(ts) AS a, max(ts) AS b FROM used JOIN bare USING (station, param) WHERE param = 'p2' AND daily GROUP BY ALL),
dg AS (SELECT station, param, file, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS ts FROM day1),
s1 AS (SELECT station, param, file, epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM used JOIN bare USING (station, param) WHERE param = 'p1' AND fine GROUP BY ALL),
g1 AS (SELECT station, param, file, unnest(generate_series(a // 900000000 * 900000000, (b + 899999999) // 900000000 * 900000000, 900000000)) AS us FROM s1),
u1 AS (SELECT station, param, file, us, max(value) AS value, max(g) AS g FROM (SELECT station, param, file, epoch_us(ts) AS us, value, 0 AS g FROM used JOIN bare USING (station, param) WHERE param = 'p1' AND fine AND value IS NOT NULL UNION ALL SELECT station, param, file, us, NULL, 1 FROM g1) GROUP BY ALL),
f1 AS (SELECT *, last_value(value IGNORE NULLS) OVER w AS v0, last_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER w AS t0, first_value(value IGNORE NULLS) OVER x AS v1, first_value(CASE WHEN value IS NOT NULL THEN us END IGNORE NULLS) OVER x AS t1 FROM u1
 WINDOW w AS (PARTITION BY station, param, file ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), x AS (PARTITION BY station, param, file ORDER BY us ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
dec AS (SELECT station, param, file, CAST(least(floor(median(length(rtrim(split_part(CAST(CAST(value AS DECIMAL(38, 10)) AS VARCHAR), '.', 2), '0')))), 4) AS INTEGER) AS d FROM used WHERE value IS NOT NULL GROUP BY ALL),
steps AS (SELECT station, param, file, ts, value FROM used JOIN bare USING (station, param) WHERE param = 'p0' OR (param = 'p2' AND NOT daily) OR (param = 'p1' AND NOT fine)
 UNION ALL SELECT g.station, g.param, g.file, g.ts, used.value FROM dg g LEFT JOIN used USING (station, param, file, ts)
 UNION ALL SELECT station, param, file, make_timestamp(us), round(coalesce(value, v0 + (v1 - v0) * (us - t0) / (t1 - t0), v0) * power(10, d)) / power(10, d) FROM f1 JOIN dec USING (station, param, file) WHERE g = 1),
merged AS (SELECT station, param, ts, arg_max(value, file) FILTER (value IS NOT NULL) AS value FROM steps GROUP BY ALL),
live AS (SELECT station, param FROM merged GROUP BY ALL HAVING count(value) >= 16)"""


def grouped(spark, sf):
    raw = grouped_files(spark, sf)
    files = raw.select(*K, "file").distinct().withColumn("header", F.concat(F.lit("from "), "file"))
    registry = raw.filter("station <> 'error'").select(F.col("station").alias("station_id"), F.concat(F.lit("Name of "), "station").alias("name")).distinct()
    as_ids = lambda d: d.withColumnRenamed("station", "station_id")
    return P.reformat_grouped(as_ids(raw), as_ids(files), registry, ["station_id", "param"], seconds=width(spark, sf))


@query("prd14_reformat_grouped", f"WITH {_GROUPED} SELECT station AS station_id, param, ts, round(value, 6) AS value, 'Name of ' || station AS name FROM merged JOIN live USING (station, param)")
def _(spark, sf):
    return grouped(spark, sf)[0].select("station_id", "param", "ts", F.round("value", 6).alias("value"), "name")


@query("prd14_grouped_headers", f"WITH {_GROUPED} SELECT station AS station_id, param, year(ts)::INTEGER AS year, max(file) AS last_file, 'from ' || max(file) AS header FROM files WHERE value IS NOT NULL GROUP BY station, param, year(ts)")
def _(spark, sf):
    return grouped(spark, sf)[1].select("station_id", "param", "year", "last_file", "header")


@query("prd14_grouped_failures", f"WITH {_GROUPED} SELECT 'view' AS station_id, 'p2' AS param, 'no rule for the steps 3600,7200' AS problem WHERE (SELECT count(*) FROM enough WHERE station = 'view' AND param = 'p2' AND file IN ('b_1', 'd_3')) = 2 UNION ALL SELECT 'error', param, 'station is not registered' FROM live_error".replace("live_error", "(SELECT DISTINCT param FROM obs WHERE station = 'error') e"))
def _(spark, sf):
    return grouped(spark, sf)[2]
