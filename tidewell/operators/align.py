"""Series side by side on time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.chunks import DEFAULT_SECONDS, prev, scan, summarize
from tidewell.operators.grid import GRID_BLOCK, _grid
from tidewell.schema import MICROS, from_micros, micros


def align_outer(frames: dict[str, DataFrame], keys=(), value="value", ts="ts") -> DataFrame:
    """JOIN-9.  One column per series, full outer on time: one aggregation over
    the union, whatever the number of series."""
    parts = [f.select(*keys, ts, F.lit(n).alias("__name"), F.col(value).alias("__v")) for n, f in frames.items()]
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy(*keys, ts).agg(*[F.max(F.when(F.col("__name") == n, F.col("__v"))).alias(n) for n in frames])


def series_arith(a, b, op: str, keys=(), value="value", ts="ts") -> DataFrame:
    """JOIN-10.  ``+`` or ``-`` of two series on equal times."""
    j = a.select(*keys, ts, F.col(value).alias("__a")).join(b.select(*keys, ts, F.col(value).alias("__b")), [*keys, ts])
    out = F.col("__a") + F.col("__b") if op == "+" else F.col("__a") - F.col("__b")
    return j.select(*keys, ts, out.alias(value))


def reindex_like(df, other, keys=(), value="value", ts="ts") -> DataFrame:
    """JOIN-12.  The times of ``other``, NULL where ``df`` has none."""
    return other.select(*keys, ts).join(df.select(*keys, ts, value), [*keys, ts], "left")


def value_asof(df, keys, step_seconds: int, value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """JOIN-13.  A step series on a regular grid: last value at or before each
    grid time, from ceil(first) to floor(last)."""
    step = F.lit(step_seconds * MICROS).cast("long")
    us = micros(ts)
    df = df.select(*keys, ts, value)
    spans = summarize(df, keys, [F.ceil(F.min(us) / step).alias("lo"), F.floor(F.max(us) / step).alias("hi")]).filter("lo <= hi")
    grid = _grid(spans, keys, GRID_BLOCK).select(*keys, from_micros(F.col("__i") * step).alias(ts),
                                                 F.lit(None).cast(df.schema[value].dataType).alias(value), F.lit(1).alias("__g"))
    u = df.select(*keys, ts, value, F.lit(0).alias("__g")).unionByName(grid)
    held = scan(u, keys, {"__v": prev(value, when=(F.col("__g") == 0) & F.col(value).isNotNull(), inclusive=True)},
                (ts, "__g"), seconds)
    return held.filter("__g = 1").select(*keys, ts, F.col("__v").alias(value))
