"""Filters and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.chunks import DEFAULT_SECONDS, overall, scan
from tidewell.operators.checks import require_empty
from tidewell.schema import col, ntz


def slice_time(df: DataFrame, start: str | None = None, end: str | None = None, ts="ts") -> DataFrame:
    """FLT-1.  Inclusive on both ends; also prunes year partitions when present."""
    df = prune_years(df, start, end) if "shard_year" in df.columns else df
    if start is not None:
        df = df.filter(F.col(ts) >= ntz(start))
    if end is not None:
        df = df.filter(F.col(ts) <= ntz(end))
    return df


def prune_years(df: DataFrame, start: str | None = None, end: str | None = None, year="shard_year") -> DataFrame:
    """FLT-2.  Keep shards whose year lies in the range; a shard without a year stays."""
    y = F.col(year)
    if start is not None:
        df = df.filter(y.isNull() | (y >= int(start[:4])))
    if end is not None:
        df = df.filter(y.isNull() | (y <= int(end[:4])))
    return df


def accept_quality(value, quality, codes, blank_good=True) -> Column:
    """FLT-3.  NULL unless the trimmed quality code is accepted (or blank)."""
    q = F.trim(col(quality))
    ok = q.isin(*[c.strip() for c in codes if c.strip()])
    if blank_good:
        ok = ok | q.isNull() | (q == "")
    return F.when(ok, col(value))


def mean_columns(*columns) -> Column:
    """FLT-4.  Row mean of the columns that are present."""
    cs = [col(c) for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
    n = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
    return F.when(n > 0, total / n)


def mask_range(value, lo=None, hi=None) -> Column:
    """FLT-5.  Out of range becomes NULL."""
    v = col(value)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (v >= lo)
    if hi is not None:
        ok = ok & (v <= hi)
    return F.when(ok, v)


def clip(value, lo=None, hi=None) -> Column:
    """FLT-6.  NULL stays NULL."""
    v = col(value)
    out = v
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(v.isNotNull(), out)


def trim_edges(df: DataFrame, keys, columns=("value",), side="both", criterion="all", ts="ts",
               seconds=DEFAULT_SECONDS) -> DataFrame:
    """FLT-7.  Drop leading and / or trailing rows where all (any) columns are
    null.  A series without a row to keep disappears."""
    nulls = [F.col(c).isNull() for c in columns]
    drop = nulls[0]
    for n in nulls[1:]:
        drop = (drop & n) if criterion == "all" else (drop | n)
    t = F.when(~drop, F.col(ts))
    s = scan(df, keys, {"__lo": overall("min", t), "__hi": overall("max", t)}, (ts,), seconds)
    keep = F.col("__lo").isNotNull()
    if side in ("both", "left"):
        keep = keep & (F.col(ts) >= F.col("__lo"))
    if side in ("both", "right"):
        keep = keep & (F.col(ts) <= F.col("__hi"))
    return s.filter(keep).drop("__lo", "__hi")


def exclude_marked(df: DataFrame, mark="exclude") -> DataFrame:
    """FLT-8.  Rows marked ``x`` are dropped; any other mark is an error."""
    m = F.col(mark)
    require_empty(df.filter(m.isNotNull() & (F.lower(m) != "x")).select(mark), "unknown mark in the exclude column")
    return df.filter(m.isNull())
