"""PRD-*.  Derived products: combinations of the operators, keyed by series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.scalars import normalize_gate_state
from tidewell.operators.aggs import gate_reduce, lag_correlation, ols_fit, resample_mean, series_decimals, sublocation_means, window_mean_replace
from tidewell.operators.align import align_outer, series_arith, value_asof
from tidewell.operators.chunks import DEFAULT_SECONDS, attach, prev, scan
from tidewell.operators.checks import require_empty, set_aside
from tidewell.operators.filters import mask_range
from tidewell.operators.grid import disaggregate, infer_freq, ingest_plan, on_steps, regularize, resample_interp
from tidewell.operators.merge import concat, dedupe, fill_from, merge_shards, ts_blend, ts_merge, ts_splice
from tidewell.operators.windows import active_ffill, cumulative_level, gaussian_smooth, interpolate, lowpass, subtidal_split
from tidewell.plans.catalog import enrich_meta, min_rows_filter
from tidewell.sources.shards import live_shards, missing_year_meta, with_shard_year
from tidewell.schema import MICROS, from_micros, micros
from tidewell.session import stage


def _filled(df, keys, limit=None, seconds=DEFAULT_SECONDS):
    return interpolate(df, keys, limit, seconds=seconds).withColumn("value", F.col("filled")).drop("filled")


def regression_impute(y, x, keys, within: Column | None = None, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-1.  Gaps of y from a line fitted on x; the prediction is everywhere."""
    both = align_outer({"y": y, "x": x}, keys)
    fit = ols_fit(both, keys, "y", "x", within)
    a = attach(both, fit, keys, seconds)
    pred = F.col("slope") * F.col("x") + F.col("intercept")
    return a.select(*keys, "ts", F.coalesce("y", pred).alias("value"), pred.alias("predicted"))


def tidal_gap_fill(obs, prediction, neighbour, keys, step_seconds: int, cutoff_seconds: int, blend_seconds: int, limit=None, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-2.  Subtidal part of the observations imputed from a neighbour and
    blended, tide from the prediction added, gaps of the raw series filled."""
    # three series of one grid are filtered in one pass, which is written for its three readers
    named = [d.select(*keys, "ts", F.col("value").cast("double").alias("value"), F.lit(n).alias("__role")) for n, d in (("obs", obs), ("near", neighbour), ("tide", prediction))]
    split = stage(subtidal_split(concat(*named), [*keys, "__role"], step_seconds, cutoff_seconds))
    part = lambda role, column: split.filter(F.col("__role") == role).select(*keys, "ts", F.col(column).alias("value"))
    so, sn, tide = part("obs", "subtidal"), part("near", "subtidal"), part("tide", "tidal")
    pred = regression_impute(so, sn, keys, seconds=seconds).select(*keys, "ts", F.col("predicted").alias("value"))
    blended = _filled(ts_blend(so, pred, keys, blend_seconds, seconds=seconds), keys, limit, seconds)
    built = series_arith(blended, tide, "+", keys)
    return ts_merge([obs, built], keys)


def neighbour_fill(y, x, keys, max_lag: int, step_seconds: int, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-3.  The neighbour shifted by its best lag, fitted, fills the gaps."""
    lag = lag_correlation(x, y, keys, max_lag, step_seconds)
    moved = attach(x, lag, keys, seconds).withColumn(
        "ts", from_micros(micros("ts") + F.coalesce("lag", F.lit(0)) * F.lit(step_seconds * MICROS).cast("long")))
    return regression_impute(y, moved.select(*keys, "ts", "value"), keys, seconds=seconds)


def flow_difference(down, tributary, keys, shift_seconds=-3 * 3600, limit=4, seconds=DEFAULT_SECONDS, strict=True) -> DataFrame:
    """PRD-4.  Filtered downstream flow minus a tributary; a negative difference
    is an error; moved in time, short gaps filled."""
    d = series_arith(down, tributary, "-", keys)
    if strict:
        require_empty(d.filter("value < 0"), "tributary larger than downstream flow")
    moved = d.withColumn("ts", from_micros(micros("ts") + F.lit(shift_seconds * MICROS).cast("long")))
    return _filled(moved, keys, limit, seconds)


def prepared_flow_difference(down, tributary, keys, step_seconds: int, cutoff_seconds=40 * 3600, pre_limit=20, shift_seconds=-3 * 3600, limit=4,
                             seconds=DEFAULT_SECONDS, strict=True) -> DataFrame:
    """PRD-4 from measured series: short gaps of the downstream flow filled, its
    tide taken out, what the filter leaves open interpolated; the tributary
    interpolated; then the difference."""
    level = lowpass(_filled(down, keys, pre_limit, seconds), keys, step_seconds, cutoff_seconds).select(*keys, "ts", F.col("filtered").alias("value"))
    return flow_difference(_filled(level, keys, seconds=seconds), _filled(tributary, keys, seconds=seconds), keys, shift_seconds, limit, seconds, strict)


def fill_total_flow(total, estimate, keys, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-8.  Gaps of the total from a second estimate at its times, the rest interpolated."""
    return _filled(_from_other(total, estimate, keys), keys, seconds=seconds)


def fill_channel_flow(channel, neighbour, keys, offset=-200.0, limit=20, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-8.  Gaps of the channel from its neighbour plus an offset, short rests interpolated."""
    return _filled(_from_other(channel, neighbour.withColumn("value", F.col("value") + offset), keys), keys, limit, seconds)


def _from_other(own, other, keys) -> DataFrame:
    """Missing values at the times of ``own`` from the other series."""
    tagged = own.select(*keys, "ts", F.struct("value").alias("own"), F.lit(None).cast("double").alias("other")).unionByName(
        other.select(*keys, "ts", F.lit(None).cast("struct<value: double>").alias("own"), F.col("value").cast("double").alias("other")))
    at = tagged.groupBy(*keys, "ts").agg(F.max("own").alias("own"), F.max("other").alias("other"))
    return at.filter("own IS NOT NULL").select(*keys, "ts", F.coalesce(F.col("own")["value"], "other").alias("value"))


def daily_to_fine_flow(daily, params, keys, period_seconds: int, step_seconds: int, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-5.  All daily stations at once.  ``params``: keys, limit_rows, add,
    subtract, low, high.  Fill gaps of up to ``limit_rows``, add, disaggregate,
    subtract, clip."""
    from tidewell.operators.chunks import following, position

    ok = F.col("value").isNotNull()
    s = scan(daily, keys, {"pos": position(), "a": prev("value", when=ok, pos=True), "b": following("value", when=ok, pos=True)}, ("ts",), seconds)
    s = attach(s, params, keys, seconds)
    step = F.col("pos") - F.col("a_pos")
    line = F.coalesce(F.col("a") + (F.col("b") - F.col("a")) * step / (F.col("b_pos") - F.col("a_pos")), F.col("a"))
    filled = F.coalesce("value", F.when(step <= F.col("limit_rows"), line)) + F.col("add")
    fine = disaggregate(s.select(*keys, "ts", filled.alias("value")), keys, period_seconds, step_seconds, seconds=seconds)
    f = attach(fine, params, keys, seconds)
    v = F.col("value") - F.col("subtract")
    return f.select(*keys, "ts", F.least(F.greatest(v, F.col("low")), F.col("high")).alias("value"))


def threshold_zero_flow(df, keys, step_seconds: int, threshold: float, limit=20, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-6.  Fine grid, short gaps filled, below the threshold and missing -> 0."""
    r = resample_interp(df, keys, step_seconds, limit, seconds=seconds)
    v = F.col("filled")
    return r.select(*keys, "ts", F.when((v < threshold) | v.isNull(), F.lit(0.0)).otherwise(v).alias("value"))


def interpolated_flow(df, keys, start: str, end: str, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-7.  Gaps filled, one time span replaced by its mean."""
    return window_mean_replace(_filled(df, keys, seconds=seconds), keys, start, end, seconds=seconds)


def split_bypass_flow(toe, elev, total, keys, elev_top=11.5, flow_top=4000.0, cap=4000.0, share=0.05, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-8.  Channel and bypass part of the total flow.  The bypass is active
    while elevation or channel flow is high; inactive, channel gaps are
    interpolated.  Channel flow is capped; of a total above the cap the channel
    takes ``share`` of the rest; negatives and low flow go to 0."""
    w = align_outer({"toe": toe, "elev": elev, "total": total}, keys)
    cond = F.when(F.col("elev").isNotNull() | F.col("toe").isNotNull(),
                  F.coalesce(F.col("elev") > elev_top, F.lit(False)) | F.coalesce(F.col("toe") > flow_top, F.lit(False)))
    a = active_ffill(w, keys, cond, "active", ("ts",), seconds).withColumn("active", F.coalesce("active", F.lit(False)))
    a = interpolate(a, keys, None, "toe", "toe_line", ("ts",), seconds)
    toe_v = F.when(F.col("active"), F.col("toe")).otherwise(F.col("toe_line"))
    a = a.withColumn("toe_v", toe_v).withColumn("tot", F.when(F.col("active"), F.col("total")).otherwise(toe_v))
    capped = F.least("toe_v", F.lit(cap))
    eff = F.when(F.col("toe_v").isNull() & F.col("active"), F.lit(cap)).when(F.col("toe_v").isNull(), F.col("tot")).otherwise(capped)
    low = F.col("tot") <= cap
    a = a.withColumn("toe_eff", F.when(F.coalesce(low, F.lit(False)), eff).otherwise(eff + share * (F.col("tot") - eff)))
    rest = F.col("tot") - F.col("toe_eff")
    return a.select(*keys, "ts", "active", "toe_eff", F.when(low, F.lit(0.0)).otherwise(F.greatest(rest, F.lit(0.0))).alias("bypass_eff"))


def exports(events, second, keys, status_map, step_seconds: int, sigma_steps: float, seconds=DEFAULT_SECONDS, tie="unit") -> DataFrame:
    """PRD-9.  Pump events to a smooth level on a grid, plus a second series; in
    cubic feet and cubic metres per second."""
    level = cumulative_level(events, keys, status_map=status_map, tie=tie, seconds=seconds)
    grid = value_asof(level.withColumnRenamed("level", "value"), keys, step_seconds, seconds=seconds)
    smooth = gaussian_smooth(grid, keys, step_seconds, sigma_steps).select(*keys, "ts", F.col("filtered").alias("value"))
    total = series_arith(smooth, second, "+", keys)
    return total.select(*keys, "ts", F.col("value").alias("cfs"), (F.col("value") * 0.028316846592).alias("cms"))


def daily_difference(fine, published, keys) -> DataFrame:
    """PRD-9.  Daily mean of a fine series against a published daily series."""
    d = resample_mean(fine, keys, 86400, fill=False)
    j = d.select(*keys, "ts", F.col("value").alias("derived")).join(published.select(*keys, "ts", F.col("value").alias("published")), [*keys, "ts"])
    return j.withColumn("difference", F.col("derived") - F.col("published"))


def boundary_table(frames: dict[str, DataFrame], ranges: dict[str, tuple], cascades: dict[str, list[str]], aliases: dict[str, str] | None = None, keys=()) -> DataFrame:
    """PRD-10.  Several series side by side, range masks, ordered fills, aliases."""
    w = align_outer(frames, keys)
    masked = {n: mask_range(n, *ranges[n]) if n in ranges else F.col(n) for n in frames}
    w = w.select(*keys, "ts", *[c.alias(n) for n, c in masked.items()])
    out = w.select(*keys, "ts", *[fill_from(*[F.col(c) for c in [n, *cascades.get(n, [])]]).alias(n) for n in frames])
    for new, old in (aliases or {}).items():
        out = out.withColumn(new, F.col(old))
    return out


def waterlevel_correct(df, offsets, keys, lo: float, hi: float, limit=5, seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-11.  Constant offset per series (keys, offset), range mask, short gaps filled."""
    a = attach(df, offsets, keys, seconds)
    v = F.col("value") + F.coalesce("offset", F.lit(0.0))
    return _filled(a.select(*keys, "ts", mask_range(v, lo, hi).alias("value")), keys, limit, seconds)


def gate_height(df, gates, thresh=0.03) -> DataFrame:
    """PRD-12."""
    n, height = gate_reduce([F.col(g) for g in gates], thresh)
    return df.select(*[c for c in df.columns if c not in gates], n.alias("ndup"), height.alias("height"))


def gate_log(archive, active, keys, states, seq="seq", seconds=DEFAULT_SECONDS) -> DataFrame:
    """PRD-13.  Archive log continued by the active one, states normalized, the
    last entry of a time kept."""
    cols = [*keys, "ts", seq, *states]
    pack = lambda d: d.select(*keys, "ts", F.struct(seq, *states).alias("value"))
    joined = ts_splice([pack(archive.select(*cols)), pack(active.select(*cols))], keys, "last", seconds=seconds)
    flat = joined.select(*keys, "ts", "value.*")
    flat = flat.select(*keys, "ts", seq, *[normalize_gate_state(s).alias(s) for s in states])
    return dedupe(flat, keys, seq, "last", states)


def reformat(raw, registry, keys, step_seconds: int, block_years=1, min_rows=8) -> tuple[DataFrame, DataFrame]:
    """PRD-14.  Raw rows (keys, ts, value) of all files to formatted shards:
    regular grid, short series dropped, registry columns, live year shards.
    Returns (formatted rows, rows of unregistered stations)."""
    r = regularize(min_rows_filter(raw, keys, min_rows), keys, step_seconds)
    good, lost = enrich_meta(r, registry)
    return live_shards(good, keys, ("value",), block_years), lost


def reformat_grouped(raw, files, registry, keys, min_points=15, block_years=1, file="file", header="header",
                     seconds=DEFAULT_SECONDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PRD-14.  Provider whose files of one series overlap and may change their step.

    ``raw``: keys, file, ts, value.  ``files``: keys, file, header.  File names
    are in the order of time.  Every file is put on the grid of its own step; a file
    with fewer than ``min_points`` valid points is left out; the steps of the others, in
    order, settle the step of the series (TIM-6), with interpolated values rounded as the file
    writes its own; the newest file wins at each time.
    Returns (formatted rows with registry columns, the header of each (series, year) with
    its last file, failures (keys, problem)).  All groups are one plan: what a series
    needs to know about its files are aggregates by (series, file)."""
    per = [*keys, file]
    own = stage(infer_freq(raw, per, seconds=seconds).select(*per, "freq"))
    odd = own.groupBy(*keys).agg(F.max(F.col("freq").isNull()).alias("__odd")).filter("__odd").select(*keys, F.lit("irregular file").alias("problem"))
    known = attach(set_aside(raw, odd, keys), own, per, seconds)
    regular = stage(regularize(known, [*per, "freq"], F.col("freq")))  # counted, merged and asked for its years
    enough = regular.groupBy(*per, "freq").agg(F.count("value").alias("__n")).filter(F.col("__n") >= min_points).select(*per, "freq")
    plan = stage(ingest_plan(enough, keys, file))
    stuck = plan.filter("problem IS NOT NULL").select(*keys, "problem")
    used = regular.join(set_aside(enough, stuck, keys).select(*per), per, "left_semi")
    facts = enough.select(*per).join(plan, list(keys)).join(series_decimals(used, per), per, "left")
    merged = stage(merge_shards(on_steps(used, per, facts, seconds=seconds), keys, file, check=False))
    good, lost = enrich_meta(live_shards(merged, keys, ("value",), block_years), registry)
    covered = regular.filter(F.col("value").isNotNull()).groupBy(*keys, F.year("ts").alias("year")).agg(F.max(file).alias("last_file"))
    headers = covered.join(files.select(*keys, F.col(file).alias("last_file"), header), [*keys, "last_file"])
    unknown = lost.select(*keys).distinct().withColumn("problem", F.lit("station is not registered"))
    bare = set_aside(missing_year_meta(with_shard_year(merged.filter("value IS NOT NULL"), 1), headers, keys).select(*keys), unknown, keys).distinct().withColumn("problem", F.lit("year without a header"))
    failures = odd.unionByName(stuck).unionByName(unknown).unionByName(bare)
    return set_aside(good, bare, keys), headers, failures


def split_sublocations(df, keys, bucket: Column) -> DataFrame:
    """PRD-15.  Sensors of a repository to one series per sublocation."""
    return sublocation_means(df.withColumn("subloc", bucket), keys, "subloc")
