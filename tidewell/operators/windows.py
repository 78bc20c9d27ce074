"""Sequence operators: filling, shifting, runs, rolling statistics, filters."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewell.operators.chunks import (
    CHUNK, DEFAULT_SECONDS, chunked, following, framed, halo_blocks, overall, position, prev, running, scan, summarize,
)
from tidewell.schema import MICROS, micros

MAX_BLOCK = 100_000


def _valid(value: str) -> Column:
    return F.col(value).isNotNull()


def interpolate(df: DataFrame, keys, limit: int | None = None, value="value", out="filled",
                order=("ts",), seconds=DEFAULT_SECONDS, keep_chunk=False) -> DataFrame:
    """WIN-1.  Linear by row position; the first ``limit`` nulls of every run
    are filled, leading nulls stay, a trailing run carries the last value."""
    s = scan(df, keys, {
        "__pos": position(),
        "__a": prev(value, when=_valid(value), pos=True),
        "__b": following(value, when=_valid(value), pos=True),
    }, order, seconds, keep_chunk)
    step = F.col("__pos") - F.col("__a_pos")
    line = F.col("__a") + (F.col("__b") - F.col("__a")) * step / (F.col("__b_pos") - F.col("__a_pos"))
    fill = F.coalesce(line, F.col("__a"))
    if limit is not None:
        fill = F.when(step <= limit, fill)
    return s.withColumn(out, F.coalesce(F.col(value), fill)).drop("__pos", "__a", "__b", "__a_pos", "__b_pos")


def interpolate_time(df, keys, value="value", out="filled", ts="ts", order=None, seconds=DEFAULT_SECONDS,
                     extend=True) -> DataFrame:
    """WIN-2.  Linear in time; ``extend`` carries the last value to the end."""
    held = F.struct(F.col(value).alias("v"), micros(ts).alias("t"))
    s = scan(df, keys, {
        "__a": prev(held, when=_valid(value)), "__b": following(held, when=_valid(value)),
    }, order or (ts,), seconds)
    a, b = F.col("__a"), F.col("__b")
    line = a["v"] + (b["v"] - a["v"]) * (micros(ts) - a["t"]) / (b["t"] - a["t"])
    fill = F.coalesce(F.col(value), line, *([a["v"]] if extend else []))
    return s.withColumn(out, fill).drop("__a", "__b")


def _fill(df, keys, sides: str, limit, value, out, order, seconds):
    specs = {"__pos": position()}
    if "f" in sides:
        specs["__a"] = prev(value, when=_valid(value), pos=True)
    if "b" in sides:
        specs["__b"] = following(value, when=_valid(value), pos=True)
    s = scan(df, keys, specs, order, seconds)
    choices = [F.col(value)]
    for name, gap in (("__a", F.col("__pos") - F.col("__a_pos") if "f" in sides else None),
                      ("__b", F.col("__b_pos") - F.col("__pos") if "b" in sides else None)):
        if gap is not None:
            choices.append(F.col(name) if limit is None else F.when(gap <= limit, F.col(name)))
    return s.withColumn(out, F.coalesce(*choices)).drop("__pos", "__a", "__a_pos", "__b", "__b_pos")


def ffill(df, keys, limit=None, value="value", out="filled", order=("ts",), seconds=DEFAULT_SECONDS):
    """WIN-3.  Last valid value, at most ``limit`` rows away."""
    return _fill(df, keys, "f", limit, value, out, order, seconds)


def bfill(df, keys, limit=None, value="value", out="filled", order=("ts",), seconds=DEFAULT_SECONDS):
    """WIN-3.  Next valid value, at most ``limit`` rows away."""
    return _fill(df, keys, "b", limit, value, out, order, seconds)


def fill_sweep(df, keys, limit=None, value="value", out="filled", order=("ts",), seconds=DEFAULT_SECONDS):
    """WIN-3.  Forward fill, then backward fill of what is left."""
    return _fill(df, keys, "fb", limit, value, out, order, seconds)


def shift(df, keys, n: int, value="value", out="shifted", order=("ts",), seconds=DEFAULT_SECONDS):
    """WIN-4.  Value ``n`` rows earlier (later when negative)."""
    if n in (1, -1):
        return scan(df, keys, {out: prev(value) if n > 0 else following(value)}, order, seconds)
    s = scan(df, keys, {"__pos": position()}, order, seconds)
    return framed(s, keys, "__pos", max(n, 0), max(-n, 0), {
        out: lambda w: F.first(value).over(w.rangeBetween(-n, -n)),
    }).drop("__pos")


def shift_time(df, seconds_by: int, ts="ts"):
    """WIN-4.  Move the clock of a series."""
    return df.withColumn(ts, F.col(ts) + F.expr(f"INTERVAL '{int(seconds_by)}' SECOND"))


def runs(df, keys, key: Column, out="run_len", order=("ts",), seconds=DEFAULT_SECONDS, keep_chunk=False):
    """Length of the run of equal ``key`` each row belongs to (NULL equals NULL).

    Inside a chunk the length is the distance of the two nearest changes.  The
    first and last run of a chunk may go on in other chunks: one summary row for
    each holds its key and length, and adjacent ones with equal keys are added up.
    """
    base = chunked(df, keys, seconds, order[0]).withColumn("__k", F.struct(key.alias("k")))
    fwd = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    bwd = Window.partitionBy(*keys, CHUNK).orderBy(*[F.desc(o) for o in order])
    rn = F.row_number().over(fwd)
    new = F.coalesce(F.lag("__k").over(fwd) != F.col("__k"), F.lit(True))
    base = base.withColumn("__rn", rn).withColumn("__new", new)
    at_new = F.when(F.col("__new"), F.col("__rn"))

    summary = summarize(base, [*keys, CHUNK], [
        F.count(F.lit(1)).alias("n"), F.min_by("__k", "__rn").alias("k0"), F.max_by("__k", "__rn").alias("k1"),
        F.min(F.when(F.col("__rn") > 1, at_new)).alias("second"), F.max(at_new).alias("last")])
    one = F.col("last") == 1
    ends = summary.select(*keys, CHUNK, F.explode(F.when(one, F.array(
        F.struct(F.lit(0).alias("e"), F.col("k0").alias("k"), F.col("n").alias("len"), F.lit(False).alias("cut")))).otherwise(F.array(
            F.struct(F.lit(0).alias("e"), F.col("k0").alias("k"), (F.col("second") - 1).cast("long").alias("len"), F.lit(False).alias("cut")),
            F.struct(F.lit(1).alias("e"), F.col("k1").alias("k"), (F.col("n") - F.col("last") + 1).alias("len"), F.lit(True).alias("cut"))))).alias("x"))
    ends = ends.select(*keys, CHUNK, "x.*")
    w = Window.partitionBy(*keys).orderBy(CHUNK, "e")
    ends = ends.withColumn("start", F.col("cut") | F.coalesce(F.lag("k").over(w) != F.col("k"), F.lit(True)))
    ends = ends.withColumn("grp", F.sum(F.col("start").cast("long")).over(w))
    ends = ends.withColumn("total", F.sum("len").over(Window.partitionBy(*keys, "grp")))
    edge = ends.groupBy(*keys, CHUNK).agg(F.max(F.when(F.col("e") == 0, F.col("total"))).alias("__first"),
                                          F.max(F.when(F.col("e") == 1, F.col("total"))).alias("__last"))
    rows = base.join(edge, [*keys, CHUNK])
    up = Window.unboundedPreceding
    start = F.last(at_new, True).over(fwd.rowsBetween(up, 0))
    stop = F.last(at_new, True).over(bwd.rowsBetween(up, -1))
    rows = rows.withColumn("__start", start).withColumn("__stop", stop)
    length = (F.when(F.col("__start") == 1, F.col("__first")).when(F.col("__stop").isNull(), F.col("__last"))
              .otherwise((F.col("__stop") - F.col("__start")).cast("long")))
    return rows.withColumn(out, length).drop(
        "__k", "__rn", "__new", "__first", "__last", "__start", "__stop", *([] if keep_chunk else [CHUNK]))


def run_length(df, keys, value="value", out="run_len", order=("ts",), seconds=DEFAULT_SECONDS, keep_chunk=False):
    """WIN-5.  Length of the run of equal non-null values; NULL on null rows."""
    r = runs(df, keys, F.col(value), out, order, seconds, keep_chunk)
    return r.withColumn(out, F.when(_valid(value), F.col(out)))


def gap_length(df, keys, value="value", gap="gap_len", good="good_len", order=("ts",),
               seconds=DEFAULT_SECONDS, keep_chunk=False):
    """WIN-6.  Lengths of the missing / valid run of each row, 0 outside it."""
    r = runs(df, keys, F.col(value).isNull(), "__len", order, seconds, keep_chunk)
    return r.withColumn(gap, F.when(_valid(value), F.lit(0)).otherwise(F.col("__len"))).withColumn(
        good, F.when(_valid(value), F.col("__len")).otherwise(F.lit(0))).drop("__len")


def good_runs_over_small_gaps(df, keys, small_gap: int, value="value", out="good_run", order=("ts",),
                              seconds=DEFAULT_SECONDS, keep_chunk=False):
    """WIN-7.  Good-run length after gaps of up to ``small_gap`` rows count as good."""
    g = gap_length(df, keys, value, "__gap", "__good", order, seconds, keep_chunk=True)
    g = g.withColumn("__ok", _valid(value) | (F.col("__gap") <= small_gap))
    r = runs(g, keys, F.col("__ok"), "__len", order, seconds, keep_chunk)
    return r.withColumn(out, F.when(F.col("__ok"), F.col("__len")).otherwise(F.lit(0))).drop(
        "__gap", "__good", "__ok", "__len")


_FRAME = {
    "center": lambda n: (-((n - 1) // 2), (n - 1) - (n - 1) // 2),
    "trailing": lambda n: (-(n - 1), 0),
    "leading": lambda n: (0, n - 1),
    "before": lambda n: (-n, -1),
    "after": lambda n: (1, n),
}


def rolling_median(df, keys, n: int, align="center", value="value", out="median", order=("ts",),
                   seconds=DEFAULT_SECONDS, block=MAX_BLOCK, pos_col: str | None = None):
    """WIN-8.  Median of the valid values among ``n`` rows.

    ``align``: center, trailing, leading (the row counts), before, after (the
    ``n`` neighbours only).
    """
    lo, hi = _FRAME[align](n)
    s = df if pos_col else scan(df, keys, {"__pos": position()}, order, seconds)
    r = framed(s, keys, pos_col or "__pos", max(-lo, 0), max(hi, 0), {
        out: lambda w: F.percentile(value, F.lit(0.5)).over(w.rangeBetween(lo, hi)),
    }, block)
    return r if pos_col else r.drop("__pos")


# --- linear filters on a regular grid ---------------------------------------

def lanczos_weights(cutoff_steps: float) -> np.ndarray:
    """Lanczos-windowed sinc (Duchon 1979), half-width 1.5 cut-off periods,
    normalized to sum 1.  ``cutoff_steps``: cut-off period in grid steps."""
    k = int(round(1.5 * cutoff_steps))
    j = np.arange(-k, k + 1)
    w = np.sinc(2.0 * j / cutoff_steps) * np.sinc(j / (k + 1.0))
    return w / w.sum()


def gaussian_weights(sigma_steps: float, truncate: float = 4.0) -> np.ndarray:
    k = int(truncate * sigma_steps + 0.5)
    j = np.arange(-k, k + 1)
    w = np.exp(-0.5 * (j / sigma_steps) ** 2)
    return w / w.sum()


def fir(df, keys, step_seconds: int, weights: np.ndarray, value="value", out="filtered", ts="ts",
        edge="null", block=MAX_BLOCK, seconds=DEFAULT_SECONDS) -> DataFrame:
    """Symmetric filter of a gridded series.  NULL where a tap is missing or
    absent; ``edge="nearest"`` repeats the first and last value instead of
    running off the ends.

    One block of one series per group, with a halo of half the filter: the
    multiply-add runs vectorized on at most ``block`` plus two halos of rows.
    Returns keys, ts, value and the filtered column.
    """
    k = (len(weights) - 1) // 2
    block = max(block, 2 * k + 1)
    step = step_seconds * MICROS
    g = df.select(*keys, ts, F.col(value).cast("double").alias(value), (micros(ts) / F.lit(step)).cast("long").alias("__i"))
    if edge == "nearest":
        g = scan(g, keys, {"__lo": overall("min", "__i"), "__hi": overall("max", "__i")}, (ts,), seconds)
    else:
        g = g.withColumn("__lo", F.lit(0).cast("long")).withColumn("__hi", F.lit(0).cast("long"))
    rows = halo_blocks(g, keys, "__i", k, k, block)
    taps = weights[::-1].copy()
    schema = T.StructType([*[f for f in g.schema.fields if f.name in (*keys, ts, value)],
                           T.StructField(out, T.DoubleType())])
    names = schema.fieldNames()

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        i = pdf["__i"].to_numpy()
        lo, hi = i.min() - k, i.max() + k
        dense = np.full(hi - lo + 1, np.nan)
        dense[i - lo] = pdf[value].to_numpy(dtype=float)
        if edge == "nearest":
            first, last = int(pdf["__lo"].iloc[0]), int(pdf["__hi"].iloc[0])
            if i.min() == first:
                dense[:k] = dense[first - lo]
            if i.max() == last:
                dense[last - lo + 1:] = dense[last - lo]
        smooth = np.convolve(dense, taps, "valid")
        pdf = pdf.assign(**{out: smooth[i - i.min()]})
        return pdf.loc[pdf["__own"], names]

    done = rows.groupBy(*keys, "__block").applyInPandas(one_block, schema)
    return done.withColumn(out, F.when(~F.isnan(out), F.col(out))).withColumn(
        value, F.when(~F.isnan(value), F.col(value)))


def lowpass(df, keys, step_seconds: int, cutoff_seconds: int, value="value", out="filtered", ts="ts", block=MAX_BLOCK):
    """WIN-9.  Low-pass filter with the given cut-off period."""
    return fir(df, keys, step_seconds, lanczos_weights(cutoff_seconds / step_seconds), value, out, ts, block=block)


def gaussian_smooth(df, keys, step_seconds: int, sigma_steps: float, value="value", out="filtered", ts="ts", block=MAX_BLOCK, seconds=DEFAULT_SECONDS):
    """WIN-10.  Gaussian filter, edge values repeated, cut at four sigma."""
    return fir(df, keys, step_seconds, gaussian_weights(sigma_steps), value, out, ts, "nearest", block, seconds)


def subtidal_split(df, keys, step_seconds: int, cutoff_seconds: int, value="value", ts="ts", block=MAX_BLOCK):
    """WIN-13.  Low-pass part ``subtidal`` and remainder ``tidal``."""
    f = lowpass(df, keys, step_seconds, cutoff_seconds, value, "subtidal", ts, block)
    return f.withColumn("tidal", F.col(value) - F.col("subtidal"))


# --- event sequences ---------------------------------------------------------

def cumulative_level(df, keys, unit="unit", status="status", capacity="capacity", status_map: dict | None = None,
                     ts="ts", tie="unit", seconds=DEFAULT_SECONDS) -> DataFrame:
    """WIN-11.  Status events of single units to the running level of the plant.

    The status text up to a comma maps to 1, 0 or NULL (an event without change).
    A unit that changes adds or removes its capacity; units start at 0.  At the
    first instant of a series a removal counts as 0.  Returns one level per ts
    at which the level changed, the last one when several events share it.
    """
    mapping = F.create_map(*[F.lit(x) for kv in (status_map or {}).items() for x in kv])
    op = F.trim(F.regexp_extract(F.col(status), r"^[^,]*", 0))
    new = F.when(op.startswith("T"), F.lit(None)).otherwise(mapping[op]).cast("int")
    e = df.select(*keys, F.col(unit).alias("unit"), F.col(capacity).cast("double").alias("capacity"),
                  F.col(ts).alias("ts"), *([F.col(tie).alias("tie")] if tie != unit else [F.col(unit).alias("tie")]),
                  new.alias("state"))
    per_unit = scan(e.filter(F.col("state").isNotNull()), [*keys, "unit"],
                    {"before": prev("state")}, ("ts", "tie"), seconds)
    delta = F.when(F.coalesce(F.col("before"), F.lit(0)) == F.col("state"), F.lit(0.0)).otherwise(
        F.when(F.col("state") == 1, F.col("capacity")).otherwise(-F.col("capacity")))
    d = per_unit.select(*keys, "ts", "tie", delta.alias("delta")).unionByName(
        e.filter(F.col("state").isNull()).select(*keys, "ts", "tie", F.lit(0.0).alias("delta")))
    d = scan(d, keys, {"t0": overall("min", "ts")}, ("ts",), seconds)
    d = d.withColumn("delta", F.when(F.col("ts") == F.col("t0"), F.greatest("delta", F.lit(0.0))).otherwise(F.col("delta")))
    at = d.groupBy(*keys, "ts").agg(F.sum("delta").alias("delta"), F.max((F.col("delta") != 0).cast("int")).alias("moved"))
    level = scan(at, keys, {"level": running("delta")}, ("ts",), seconds)
    return level.filter("moved = 1").select(*keys, "ts", "level")


def dst_to_standard(df, keys, zone="tz", daylight="PDT", ts="ts", value="value", seq="seq"):
    """WIN-12.  Naive local time with a zone code to standard time: daylight rows
    move back one hour; of rows that then share a time the first one stays."""
    moved = F.when(F.col(zone) == daylight, F.col(ts) - F.expr("INTERVAL 1 HOUR")).otherwise(F.col(ts))
    return df.groupBy(*keys, moved.alias("ts")).agg(F.min_by(value, seq).alias("value"))


def active_ffill(df, keys, condition: Column, out="active", order=("ts",), seconds=DEFAULT_SECONDS):
    """WIN-14.  A condition known at some rows (NULL elsewhere) held forward."""
    s = df.withColumn("__cond", condition)
    return scan(s, keys, {out: prev("__cond", when=F.col("__cond").isNotNull(), inclusive=True)}, order, seconds).drop("__cond")
