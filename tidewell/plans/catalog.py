"""CAT-5..17, CFG-1.  Inventories, registries, metadata and provider order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.names import series_id, wildcard_name
from tidewell.operators.checks import require_empty
from tidewell.operators.chunks import DEFAULT_SECONDS, attach

OPEN_END = 9999
# Columns of the registry and the file list that no inventory shows
NOISE = ("notes", "stage", "flow", "quality", "wdl_id", "cdec_id", "d1641_id", "original_filename")


def _inventory(files: DataFrame, group: Column, name: str, attrs) -> DataFrame:
    year = lambda c: F.col(c).try_cast("int")
    lo = F.coalesce(year("syear"), year("year"))
    hi = F.coalesce(year("eyear"), year("year"))
    return files.groupBy(group.alias(name)).agg(
        *[F.min_by(a, "file").alias(a) for a in attrs], F.min(lo).alias("min_year"), F.max(hi).alias("max_year"))


def _finish(inv: DataFrame, registry: DataFrame | None, units: DataFrame | None, on: str) -> DataFrame:
    if registry is not None:
        dup = [c for c in registry.columns if c in inv.columns and c != "station_id"]
        inv = inv.join(registry.drop(*dup), "station_id", "left")
    if units is not None:
        inv = inv.join(units, on, "left")
    return inv.drop(*[c for c in NOISE if c in inv.columns])


ATTRS = ("source", "station_id", "subloc", "agency_id", "param")


def file_inventory(files: DataFrame, registry=None, units=None, attrs=ATTRS) -> DataFrame:
    """CAT-5.  One row per wildcard name.  ``files``: file and the parsed name fields."""
    return _finish(_inventory(files, wildcard_name("file"), "file_pattern", attrs), registry, units, "file_pattern")


def data_inventory(files: DataFrame, registry=None, units=None, attrs=("station_id", "subloc", "param"), data_key=("station_id", "subloc", "param")) -> DataFrame:
    """CAT-6.  One row per series, whatever the provider."""
    fields = {k: F.col(k) for k in data_key}
    return _finish(_inventory(files, series_id(fields, data_key), "series_id", attrs), registry, units, "series_id")


def strip_keys(df: DataFrame, keys=("station_id", "agency_id")) -> DataFrame:
    for k in keys:
        if k in df.columns:
            df = df.withColumn(k, F.regexp_replace(F.trim(F.col(k).cast("string")), r"""['"]""", ""))
    return df


def registry_problems(parts: dict[str, DataFrame]) -> DataFrame:
    """CAT-7.  Duplicate keys, keys in more than one registry, missing agency ids."""
    u = _tagged(parts)
    n = u.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("registry").alias("r"))
    dup = n.filter("n > r").select("station_id", F.lit("duplicate_key").alias("problem"))
    over = n.filter("r > 1").select("station_id", F.lit("in_several_registries").alias("problem"))
    none = u.filter("agency_id IS NULL OR agency_id = ''").select("station_id", F.lit("no_agency_id").alias("problem"))
    return dup.unionByName(over).unionByName(none)


def _tagged(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [strip_keys(d).withColumn("registry", F.lit(n)) for n, d in parts.items()])


def union_registries(parts: dict[str, DataFrame], crs: dict[str, str] | None = None) -> DataFrame:
    """CAT-7.  One registry out of several, or an error."""
    if crs and len(set(crs.values())) > 1:
        raise ValueError(f"registries use different coordinate systems: {crs}")
    require_empty(registry_problems(parts), "registries do not fit")
    return _tagged(parts)


SEARCHED = ("station_id", "station_name", "agency_id", "agency")


def search_registry(parts: dict[str, DataFrame], phrase: str) -> DataFrame:
    """CAT-8.  Case-insensitive substring over ids, names and agencies."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.lower(F.col(c).cast("string")).contains(phrase.lower()), F.lit(False)) for c in SEARCHED])
    return _tagged(parts).filter(hit).orderBy("station_id", "registry")


def filter_inventory(inv: DataFrame, stations=None, params=None) -> DataFrame:
    """CAT-9.  Membership filters by list or by DataFrame."""
    for name, want in (("station_id", stations), ("param", params)):
        if isinstance(want, DataFrame):
            inv = inv.join(want.select(name).distinct(), name, "left_semi")
        elif want:
            inv = inv.filter(F.col(name).isin(*want))
    return inv


def valid_span(df: DataFrame, keys, open_end: Column | None = None, value="value", ts="ts") -> DataFrame:
    """CAT-10.  First and last year with a valid value; ``empty`` series are for
    removal; an open end stays 9999."""
    ok = F.when(F.col(value).isNotNull(), F.year(ts))
    aggs = [F.min(ok).alias("syear"), F.max(ok).alias("eyear")]
    if open_end is not None:
        aggs.append(F.bool_or(open_end).alias("open"))
    s = df.groupBy(*keys).agg(*aggs)
    if open_end is not None:
        s = s.withColumn("eyear", F.when(F.col("open"), F.lit(OPEN_END)).otherwise(F.col("eyear"))).drop("open")
    return s.withColumn("empty", F.col("syear").isNull())


def existing_series(catalog: DataFrame, keys=("station_id", "param")) -> DataFrame:
    """CAT-11."""
    return catalog.select(*keys).dropDuplicates()


def drop_held(request: DataFrame, catalog: DataFrame, keys=("station_id", "param")) -> DataFrame:
    """CAT-11.  Requests for series that are not held yet."""
    return request.join(existing_series(catalog, keys), list(keys), "left_anti")


def min_rows_filter(df: DataFrame, keys, n=8, value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """CAT-12.  Series with fewer than ``n`` valid points dropped."""
    good = df.groupBy(*keys).agg(F.count(value).alias("__n")).filter(F.col("__n") >= n)
    return attach(df, good, keys, seconds, ts).filter("__n IS NOT NULL").drop("__n")


# CAT-13.  Fixed values: unit texts (lower case) and the unit a parameter has by default
UNIT_ALIASES = {
    "feet": "feet", "foot": "feet", "ft": "feet", "us/cm": "uS/cm", "microsiemens/cm": "uS/cm", "mg/l": "mg/l", "mgl": "mg/l",
    "milligrams/litre": "mg/l", "cfs": "ft^3/s", "cubic feet/second": "ft^3/s", "ft/sec": "ft/s", "fts": "ft/s", "feet/second": "ft/s",
    "ph": "pH", "psu": "psu", "pss-15": "psu", "deg f": "deg_f", "degf": "deg_f", "degrees farenheit": "deg_f", "deg c": "deg_c",
    "degc": "deg_c", "degrees c": "deg_c", "degrees celsius": "deg_c", "ntu": "NTU", "fnu": "FNU", "micrograms/litre": "ug/l", "ut": "ug/l",
    "quinine sulfate unit": "ug/l",
}
# Unit texts of the USGS parameter list that differ from the canonical ones
USGS_ALIASES = {"ft": "feet", "ft3/s": "ft^3/s", "us/cm @25c": "uS/cm", "ft/sec": "ft/s", "m/sec": "m/s", "ng/m3": "ng/m^3", "deg c": "deg_c"}
PARAM_UNITS = {"ec": "uS/cm", "turbidity": "NTU", "elev": "feet", "temp": "deg_c", "velocity": "ft/s", "flow": "ft^3/s", "fdom": "ug/l", "do": "mg/l"}


def unit_aliases(spark, extra: list[tuple[str, str, str]] = ()) -> DataFrame:
    """Alias table (provider, raw, unit); provider ``*`` serves all."""
    rows = [("*", k, v) for k, v in UNIT_ALIASES.items()] + [("usgs", k, v) for k, v in USGS_ALIASES.items()] + list(extra)
    return spark.createDataFrame(rows, "provider string, raw string, unit string")


def infer_unit(df: DataFrame, aliases: DataFrame, provider="provider", param="param", raw="raw_unit") -> DataFrame:
    """CAT-13.  Unit text to canonical unit: alias of the provider, alias of all,
    default of the parameter (blank or ``misc``), else ``unknown``.  A USGS text
    without an alias is its own unit; where only a parameter code is known,
    ``usgs_raw_unit`` gives the text first."""
    d = df.withColumn("__raw", F.lower(F.trim(raw)))
    own = aliases.filter("provider != '*'").select(F.col("provider").alias(provider), F.col("raw").alias("__raw"), F.col("unit").alias("__own"))
    gen = aliases.filter("provider = '*'").select(F.col("raw").alias("__raw"), F.col("unit").alias("__gen"))
    j = d.join(own, [provider, "__raw"], "left").join(gen, "__raw", "left")
    by_param = F.create_map(*[F.lit(x) for kv in PARAM_UNITS.items() for x in kv])[F.col(param)]
    blank = F.col("__raw").isNull() | F.col("__raw").isin("", "misc")
    itself = F.when((F.col(provider) == "usgs") & ~blank, F.trim(raw))
    return j.withColumn("unit", F.coalesce("__own", "__gen", F.when(blank, by_param), itself, F.lit("unknown"))).drop("__raw", "__own", "__gen")


def usgs_param_code(header: Column | str) -> Column:
    """CAT-13.  Parameter code in a USGS header: ``variable_code`` of a JSON
    header, or the third word after the ``Parameter  Description`` line."""
    h = F.col(header) if isinstance(header, str) else header
    code = F.regexp_extract(h, r"variable_code[^:\n]*:\s*'?([^'\s]+)", 1)
    listed = F.regexp_extract(h, r"Parameter\s+Description[^\n]*\n#?\s*\S+\s+(?:#\s*)?\S+\s+(\d{5})", 1)
    return F.coalesce(F.nullif(code, F.lit("")), F.nullif(listed, F.lit("")))


def usgs_raw_unit(df: DataFrame, parameters: DataFrame, code="param_code", raw="raw_unit") -> DataFrame:
    """CAT-13.  Unit text from the parameter list (parm_cd, parm_unit) where none is given."""
    p = parameters.select(F.col("parm_cd").alias(code), F.col("parm_unit").alias("__unit"))
    return df.join(p, code, "left").withColumn(raw, F.coalesce(F.nullif(F.trim(raw), F.lit("")), "__unit")).drop("__unit")


def enrich_meta(parsed: DataFrame, registry: DataFrame, units: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """CAT-14.  (rows with registry columns and unit, rows of unregistered stations)."""
    cols = [c for c in registry.columns if c == "station_id" or c not in parsed.columns]
    j = parsed.join(registry.select(*cols, F.lit(True).alias("__reg")), "station_id", "left")
    if units is not None:
        j = j.join(units, ["station_id", "param"], "left").withColumn("unit", F.coalesce("unit", F.lit("unknown")))
    return j.filter("__reg").drop("__reg"), j.filter("__reg IS NULL").select(*parsed.columns)


def resolve_meta_sentinels(df: DataFrame, registry: DataFrame, fields, parsed="parsed", key="station_id") -> DataFrame:
    """CAT-15.  Sentinel texts of metadata fields: ``infer_from_filename`` takes
    the parsed name, ``infer_from_agency_id`` the one registry row of the agency
    id (none or several is an error), ``registry_lookup`` the registry row of the
    station; any other text is literal."""
    by_agency = registry.groupBy("agency_id").agg(F.count(F.lit(1)).alias("__n"), F.min("station_id").alias("__st"))
    j = df.join(by_agency, "agency_id", "left")
    one = F.when(F.col("__n") == 1, F.col("__st")).otherwise(
        F.raise_error(F.concat(F.lit("agency id does not name one station: "), F.coalesce("agency_id", F.lit("?")))).cast("string"))
    k = F.when(F.col(key) == "infer_from_agency_id", one).when(F.col(key) == "infer_from_filename", F.col(parsed)[key]).otherwise(F.col(key))
    j = j.withColumn(key, k).drop("__n", "__st")
    looked = [f for f in fields if f in registry.columns]
    reg = registry.select(F.col("station_id").alias(key), *[F.col(f).cast("string").alias(f"__r_{f}") for f in looked])
    j = j.join(reg, key, "left")
    parsed_fields = j.schema[parsed].dataType.fieldNames()
    for f in fields:
        v = F.col(f)
        out = F.when(v == "infer_from_filename", F.col(parsed)[f]) if f in parsed_fields else F.when(F.lit(False), v)
        if f in looked:
            out = out.when(v == "registry_lookup", F.col(f"__r_{f}"))
        j = j.withColumn(f, out.otherwise(v))
    return j.drop(*[f"__r_{f}" for f in looked])


REQUIRED_META = ("station_id", "source", "agency", "param", "unit", "time_zone")
LOWER_META = ("source", "agency", "param", "station_id", "subloc")


def meta_problems(df: DataFrame, zones, required=REQUIRED_META, key="station_id") -> DataFrame:
    """CAT-16.  (key, problem) for every rule a metadata row breaks."""
    c = lambda n: F.col(n) if n in df.columns else F.lit(None)
    rules = [(f"missing_{r}", c(r).isNull()) for r in required]
    rules += [(f"not_lower_{r}", c(r).cast("string") != F.lower(c(r).cast("string"))) for r in LOWER_META if r in df.columns]
    rules.append(("bad_time_zone", ~c("time_zone").isin(*zones)))
    there = lambda n: c(n).isNotNull() & (c(n).cast("double") != -9999.0)
    rules.append(("no_coordinates", ~((there("latitude") & there("longitude")) | (there("x") & there("y")))))
    found = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(n)) for n, bad in rules]), lambda x: x.isNotNull())
    return df.select(key, F.explode(found).alias("problem"))


def year_metadata(df: DataFrame, keys, meta: str, file="file", value="value", ts="ts") -> DataFrame:
    """CAT-17.  For each (series, year with valid data) the metadata of the last
    file that covers it."""
    ok = df.filter(F.col(value).isNotNull())
    return ok.groupBy(*keys, F.year(ts).alias("year")).agg(F.max_by(meta, file).alias(meta), F.max(file).alias("last_file"))


# Providers to read for the agency that observes, best first
PROVIDER_ORDER = {
    "ncro": ["ncro", "cdec"], "dwr_ncro": ["ncro", "cdec"], "des": ["des"], "dwr_des": ["des"], "usgs": ["usgs", "ebmud"], "noaa": ["noaa"],
    "usbr": ["usgs", "usbr", "cdec"], "dwr_om": ["cdec"], "dwr": ["dwr", "cdec"], "ebmud": ["usgs", "ebmud", "cdec"],
}


def priority_table(spark, order: dict[str, list[str]] = PROVIDER_ORDER) -> DataFrame:
    rows = [(a, p, i) for a, ps in order.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "agency string, provider string, prio int")


def provider_order(series: DataFrame, registry: DataFrame | None, priorities: DataFrame | None, mode="registry_column", station="station") -> DataFrame:
    """CFG-1.  (station, provider, prio).  ``assume_unique``: more than one
    provider of a series is an error."""
    have = series.select(station, "provider").distinct()
    if mode == "assume_unique":
        n = have.groupBy(station).agg(F.count(F.lit(1)).alias("n"))
        require_empty(n.filter("n > 1"), "more than one provider")
        return have.withColumn("prio", F.lit(0))
    j = have.join(registry.select(station, "agency"), station).join(priorities, ["agency", "provider"])
    return j.select(station, "provider", "prio")
