"""Requests: which station, sublocation, parameter and source to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.operators.checks import require_empty
from tidewell.schema import DEFAULT_SUBLOC


def normalize_request(df, param: str | None = None, station="station_id", subloc="subloc", param_col="param") -> DataFrame:
    """JOIN-1.  ``id@subloc`` split, ``param`` put on blanks, lower case and
    trimmed, unspecified sublocation NULL."""
    text = F.lower(F.trim(F.col(station)))
    parts = F.split(text, "@")
    given = F.lower(F.trim(F.col(subloc))) if subloc in df.columns else F.lit(None).cast("string")
    given = F.when(given.isin("", DEFAULT_SUBLOC), F.lit(None)).otherwise(given)
    own = F.lower(F.trim(F.col(param_col))) if param_col in df.columns else F.lit(None).cast("string")
    own = F.when(own != "", own)
    rest = [c for c in df.columns if c not in (station, subloc, param_col)]
    return df.select(parts[0].alias(station), F.coalesce(F.when(F.size(parts) > 1, parts[1]), given).alias(subloc),
                     F.coalesce(own, F.lit(param)).alias(param_col), *rest)


def attach_agency_id(req, registry, on_missing="raise", station="station_id") -> DataFrame:
    """JOIN-2.  Agency id of each station; a station without one is an error or dropped."""
    j = req.join(registry.select(station, "agency_id"), station, "left")
    if on_missing == "drop":
        return j.filter("agency_id IS NOT NULL")
    require_empty(j.filter("agency_id IS NULL").select(station), "stations without agency id")
    return j


def attach_subloc(req, sublocs, station="station_id", subloc="subloc") -> DataFrame:
    """JOIN-3.  A requested sublocation stays; else one row per known one; else default."""
    known = sublocs.select(station, F.col(subloc).alias("__known")).distinct()
    asked = req.filter(F.col(subloc).isNotNull())
    open_ = req.filter(F.col(subloc).isNull()).join(known, station, "left")
    open_ = open_.withColumn(subloc, F.coalesce("__known", F.lit(DEFAULT_SUBLOC))).drop("__known")
    return asked.select(*req.columns).unionByName(open_.select(*req.columns)).distinct()


def attach_src_var_id(req, mapping, source: str, param="param") -> DataFrame:
    """JOIN-4.  Provider variable ids of the parameter (many to many), else the parameter itself."""
    m = mapping.filter(F.col("src_name") == source).select(F.col("var_name").alias(param), "src_var_id").distinct()
    j = req.join(m, param, "left")
    return j.withColumn("src_var_id", F.coalesce("src_var_id", F.col(param)))


def merge_station_subloc(stations, sublocs, default_z: float = -0.5, station="station_id") -> DataFrame:
    """JOIN-5."""
    j = stations.join(sublocs.select(station, "subloc", "z"), station, "left")
    return j.withColumn("subloc", F.coalesce("subloc", F.lit(DEFAULT_SUBLOC))).withColumn("z", F.coalesce("z", F.lit(default_z)))


def site_aliases(station) -> Column:
    """JOIN-7.  Base id, base + Q, base + 00, with an ending Q or 00 cut first."""
    s = F.col(station) if isinstance(station, str) else station
    base = F.regexp_replace(F.upper(s), r"(Q|00)$", "")
    return F.array(base, F.concat(base, F.lit("Q")), F.concat(base, F.lit("00")))


def inventory_overlap(req, inventory, station="station_id", param="param") -> DataFrame:
    """JOIN-6.  Inventory rows whose site is an alias of the requested station,
    with the same parameter and an overlapping time span.  The aliases are
    spelled out, so the join is an equality with a range condition."""
    r = req.withColumn("site", F.explode(site_aliases(station)))
    i = inventory.select(F.upper("site").alias("site"), F.col(param), "start", "end")
    j = r.join(i, ["site", param])
    return j.filter((F.col("start") <= F.col("req_end")) & (F.col("end") >= F.col("req_start")))


def superseded(files, keys, file="file") -> DataFrame:
    """JOIN-11.  Files whose year span lies inside the span of another file of the
    series; of equal spans the lexically last file stays.

    The files are first reduced to the distinct spans of a series, few whatever
    the number of files.  A span is inside another one exactly when, in order of
    (start, longest first), an earlier one ends at or after it: a running
    maximum, not a self join.
    """
    spans = files.groupBy(*keys, "syear", "eyear").agg(F.max(file).alias("__last"))
    w = Window.partitionBy(*keys).orderBy("syear", F.desc("eyear")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__end", F.max("eyear").over(w))
    j = files.join(spans, [*keys, "syear", "eyear"])
    inside = F.coalesce(F.col("__end") >= F.col("eyear"), F.lit(False)) | (F.col(file) < F.col("__last"))
    return j.filter(inside).select(*files.columns)


def build_request(registry, sublocs, mapping, agency: str, param: str, held: DataFrame, source: str, on_missing="drop") -> DataFrame:
    """PRD-18.  Registry rows of an agency to the request for one parameter:
    sublocations, series already held dropped, ids and names attached."""
    rows = registry.filter(F.col("agency") == agency).select("station_id")
    r = merge_station_subloc(rows, sublocs).withColumn("param", F.lit(param))
    r = r.join(held.select("station_id", "param").distinct(), ["station_id", "param"], "left_anti")
    r = attach_agency_id(normalize_request(r, param), registry, on_missing)
    r = attach_src_var_id(r, mapping, source)
    named = r.join(registry.select("station_id", "station_name"), "station_id", "left")
    require_empty(named.filter("station_name IS NULL").select("station_id"), "stations without a name")
    return named.withColumn("subloc", F.coalesce("subloc", F.lit(DEFAULT_SUBLOC)))
