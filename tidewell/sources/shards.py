"""SRC-7..9, 14, 15.  The shard store: year partitions, manifests, hourly files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewell.operators.checks import require_empty
from tidewell.operators.filters import slice_time
from tidewell.operators.grid import year_block
from tidewell.operators.screen import apply_flags

MIN_POINTS = 16


def with_shard_year(df: DataFrame, block_years=1, ts="ts") -> DataFrame:
    return df.withColumn("shard_year", year_block(F.year(ts), block_years))


def live_shards(df: DataFrame, keys, values=("value",), block_years=1, min_points=MIN_POINTS, ts="ts") -> DataFrame:
    """SRC-8.  Rows with their shard year, of shards in which some column has at
    least ``min_points`` valid points."""
    d = with_shard_year(df, block_years, ts)
    counts = d.groupBy(*keys, "shard_year").agg(F.greatest(*[F.count(v) for v in values], F.lit(0)).alias("n")).filter(F.col("n") >= min_points)
    return d.join(counts.select(*keys, "shard_year"), [*keys, "shard_year"], "left_semi")


def missing_year_meta(shards: DataFrame, meta: DataFrame, keys=()) -> DataFrame:
    """SRC-9.  Shards to write that have no metadata for their year."""
    return shards.select(*keys, "shard_year").distinct().join(meta.select(*keys, F.col("year").alias("shard_year")), [*keys, "shard_year"], "left_anti")


def write_shards(df: DataFrame, path: str, keys: Sequence[str], values=("value",), block_years=1, year_meta: DataFrame | None = None,
                 param="param", mode="overwrite") -> DataFrame:
    """SRC-8.  Write parquet partitioned by parameter and year, sorted by (series,
    time), so that a read prunes partitions and row groups.  Returns the rows."""
    d = live_shards(df, keys, values, block_years)
    if year_meta is not None:
        require_empty(missing_year_meta(d, year_meta), "no metadata for shards")
    # a year of one parameter is spread over tasks by series and month, not one task per partition
    out = d.withColumn("__m", F.month("ts")).repartition(param, "shard_year", *[k for k in keys if k != param], "__m").drop("__m")
    out.sortWithinPartitions(param, "shard_year", *[k for k in keys if k != param], "ts").write.mode(mode).option(
        "partitionOverwriteMode", "dynamic").partitionBy(param, "shard_year").parquet(path)
    return d


def read_shards(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, param: str = "param") -> DataFrame:
    """Observations of a store; the year range prunes partitions.  Parameters are
    texts, also those that look like numbers."""
    fields = [T.StructField(f.name, T.StringType() if f.name == param else f.dataType, f.nullable) for f in spark.read.parquet(path).schema.fields]
    return slice_time(spark.read.schema(T.StructType(fields)).parquet(path), start, end)


def read_flagged(df: DataFrame, start=None, end=None, apply=True, return_flags=False, value="value", flag="user_flag") -> DataFrame:
    """SRC-7.  Screened rows in a time range, flagged values NULL unless ``apply``
    is off, the flag dropped unless asked for."""
    d = slice_time(df, start, end)
    if apply:
        d = d.withColumn(value, apply_flags(value, flag))
    return d if return_flags else d.drop(flag)


def hour_time(date: Column | str, hour: Column | str) -> Column:
    """SRC-14.  ``M/d/yyyy`` and hour 0100 .. 2400 to a time; 2400 is the next day."""
    d = F.try_to_timestamp(F.col(date) if isinstance(date, str) else date, F.lit("M/d/yyyy"))
    h = F.floor((F.col(hour) if isinstance(hour, str) else hour).try_cast("int") / 100)
    return F.timestamp_micros(F.unix_micros(d) + h * 3_600_000_000).cast("timestamp_ntz")


def hourly_station(parts: list[DataFrame], keys, values, date="date", hour="hour") -> DataFrame:
    """SRC-14.  Archive, current year and current month; the last part wins at
    each time."""
    u = None
    for i, p in enumerate(parts):
        d = p.select(*keys, hour_time(date, hour).alias("ts"), *[F.col(v).try_cast("double").alias(v) for v in values], F.lit(i).alias("__i"))
        u = d if u is None else u.unionByName(d)
    return u.groupBy(*keys, "ts").agg(F.max_by(F.struct(*values), "__i").alias("r")).select(*keys, "ts", "r.*")


REQUIRED = ("station_id", "param", "provider")


def manifest_problems(df: DataFrame, providers) -> DataFrame:
    d = df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in REQUIRED]).withColumn("provider", F.lower("provider"))
    bad = d.filter(~F.col("provider").isin(*providers)).select(*REQUIRED, F.lit("unsupported_provider").alias("problem"))
    twice = d.groupBy(*REQUIRED).count().filter("count > 1").select(*REQUIRED, F.lit("duplicate").alias("problem"))
    return bad.unionByName(twice)


def read_daily_manifest(df: DataFrame, providers) -> DataFrame:
    """SRC-15.  Checked and trimmed manifest."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"manifest lacks columns {missing}")
    require_empty(manifest_problems(df, providers), "bad manifest rows")
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in REQUIRED]).withColumn("provider", F.lower("provider"))
