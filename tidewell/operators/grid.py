"""Time grids and frequencies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewell.operators.chunks import CHUNK, DEFAULT_SECONDS, attach, chunked, following, prev, scan, summarize
from tidewell.operators.windows import interpolate
from tidewell.schema import MICROS, from_micros, micros
from tidewell.session import stage

GRID_BLOCK = 100_000


def infer_freq(df, keys, ts="ts", share=0.9, seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-1.  Dominant step of each series in whole seconds; NULL (irregular)
    when it covers less than ``share`` of the steps.  Ties: the smaller step."""
    s = scan(df.select(*keys, ts), keys, {"__p": prev(ts)}, (ts,), seconds)
    n = s.groupBy(*keys, (micros(ts) - micros("__p")).alias("us")).count()  # us is NULL at the first row
    step = F.col("us").isNotNull()
    best = n.groupBy(*keys).agg(
        F.min_by("us", F.when(step, F.struct(-F.col("count"), F.col("us")))).alias("us"),
        F.max(F.when(step, F.col("count"))).alias("top"), F.coalesce(F.sum(F.when(step, F.col("count"))), F.lit(0)).alias("steps"))
    return best.select(*keys, F.when(F.col("top") >= share * F.col("steps"), F.col("us") / MICROS).cast("long").alias("freq"), "steps")


def step_micros(step_seconds: int | Column) -> Column:
    """A step in microseconds; the step may be a column of the rows."""
    return step_seconds.cast("long") * MICROS if isinstance(step_seconds, Column) else F.lit(step_seconds * MICROS).cast("long")


def grid_index(ts, step_seconds: int | Column) -> Column:
    """Nearest grid index in integer microseconds, ties to the even index."""
    step = step_micros(step_seconds)
    us = micros(ts)
    rest = F.pmod(us, step)
    q = ((us - rest) / step).cast("long")
    up = (rest * 2 > step) | ((rest * 2 == step) & (F.pmod(q, F.lit(2)) == 1))
    return q + F.when(up, 1).otherwise(0)


def exact_index(ts, step_seconds: int) -> Column:
    """Grid index of a time on the grid, NULL off it."""
    step = F.lit(step_seconds * MICROS).cast("long")
    us = micros(ts)
    return F.when(F.pmod(us, step) == 0, (us / step).cast("long"))


def index_time(i, step_seconds: int | Column) -> Column:
    return from_micros((F.col(i) if isinstance(i, str) else i) * step_micros(step_seconds))


def _grid(spans: DataFrame, keys, block: int, extra=()) -> DataFrame:
    """Rows (keys, __block, __i) for every index in [lo, hi]: the blocks of a
    series first, then the points of each block, so no task holds a whole series."""
    b = spans.select(*keys, *extra, "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / block), F.floor(F.col("hi") / block))).alias("__block")).repartition(*keys, "__block")
    return b.select(*keys, *extra, "__block", F.explode(F.sequence(
        F.greatest("lo", F.col("__block") * block),
        F.least("hi", F.col("__block") * block + (block - 1)))).alias("__i"))


def sparse_series(df, keys, step_seconds: int, max_expand: int, ts="ts") -> DataFrame:
    """REC-17.  Series whose grid would be more than ``max_expand`` times their
    rows (keys, points, reason), to be looked at: their step may be wrong.  The
    grid operators have no such limit."""
    i = micros(ts) / F.lit(step_seconds * MICROS).cast("long")
    n = df.groupBy(*keys).agg((F.max(i) - F.min(i) + 1).cast("long").alias("points"), F.count(F.lit(1)).alias("__n"))
    return n.filter(F.col("points") > F.col("__n") * max_expand).select(*keys, "points", F.lit("sparse_grid").alias("reason"))


def complete(df, keys, idx: str, values, block: int = GRID_BLOCK) -> DataFrame:
    """Every grid point from the first to the last index, NULL where absent.  A
    sparse series has a long grid; its blocks are made in parallel."""
    spans = summarize(df, keys, [F.min(idx).alias("lo"), F.max(idx).alias("hi")])
    grid = _grid(spans, keys, block)
    data = df.select(*keys, F.floor(F.col(idx) / block).alias("__block"), F.col(idx).alias("__i"), *values)
    blank = grid.select("*", *[F.lit(None).cast(df.schema[v].dataType).alias(v) for v in values])
    both = data.unionByName(blank).repartition(*keys, "__block")
    full = both.groupBy(*keys, "__block", "__i").agg(*[F.max(v).alias(v) for v in values])
    return full.drop("__block").withColumnRenamed("__i", idx)


def regularize(df, keys, step_seconds: int | Column, value="value", ts="ts", fill=True) -> DataFrame:
    """TIM-2.  Round every time to the grid.  Of the rows on one grid point keep
    a valid one first, then the nearest, then the earliest; then complete.  The
    step may be one of the key columns, so series of many steps are one plan."""
    step = step_micros(step_seconds)
    us = micros(ts)
    g = df.select(*keys, grid_index(ts, step_seconds).alias("__i"), us.alias("__us"), value)
    best = g.groupBy(*keys, "__i").agg(F.min_by(value, F.struct(
        F.col(value).isNull(), F.abs(F.col("__us") - F.col("__i") * step), F.col("__us"))).alias(value))
    full = complete(best, keys, "__i", [value]) if fill else best
    return full.select(*keys, index_time("__i", step_seconds).alias(ts), value)


def asfreq(df, keys, step_seconds: int, values=("value",), ts="ts") -> DataFrame:
    """TIM-3.  Grid of ``step`` from the first to the last time of the series,
    exact matches only.  The grid starts at the first time of the series."""
    step = F.lit(step_seconds * MICROS).cast("long")
    d = df.select(*keys, micros(ts).alias("__us"), *values)
    spans = summarize(d, keys, [F.min("__us").alias("__t0"), F.max("__us").alias("__t1")])
    spans = spans.withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.floor((F.col("__t1") - F.col("__t0")) / step))
    grid = _grid(spans, keys, GRID_BLOCK, ["__t0"]).select(
        *keys, (F.col("__t0") + F.col("__i") * step).alias("__us"), *[F.lit(None).cast(df.schema[v].dataType).alias(v) for v in values], F.lit(1).alias("__g"))
    both = d.withColumn("__g", F.lit(0)).unionByName(grid)
    at = both.groupBy(*keys, "__us").agg(*[F.max(v).alias(v) for v in values], F.max("__g").alias("__g"))
    return at.filter("__g = 1").select(*keys, from_micros(F.col("__us")).alias(ts), *values)


def interp_to(df, keys, step_seconds: int, decimals: DataFrame | None = None, value="value", ts="ts",
              seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-4.  Grid from floor(first) to ceil(last), linear in time between the
    valid values, rounded to the decimals of the series (keys, decimals)."""
    step = F.lit(step_seconds * MICROS).cast("long")
    us = micros(ts)
    d = df.select(*keys, us.alias("__us"), F.col(value).cast("double").alias(value))
    valid = d.filter(F.col(value).isNotNull())
    spans = summarize(d, keys, [F.floor(F.min("__us") / step).alias("lo"), F.ceil(F.max("__us") / step).alias("hi")])
    grid = _grid(spans, keys, GRID_BLOCK).select(*keys, (F.col("__i") * step).alias("__us"),
                                                 F.lit(None).cast("double").alias(value), F.lit(1).alias("__g"))
    both = valid.withColumn("__g", F.lit(0)).unionByName(grid)
    one = both.groupBy(*keys, "__us").agg(F.max(value).alias(value), F.max("__g").alias("__g"))
    one = one.withColumn(ts, from_micros(F.col("__us")))
    held = F.struct(F.col(value).alias("v"), F.col("__us").alias("t"))
    ok = F.col(value).isNotNull()
    s = scan(one, keys, {"__a": prev(held, when=ok), "__b": following(held, when=ok)}, (ts,), seconds)
    a, b = F.col("__a"), F.col("__b")
    line = a["v"] + (b["v"] - a["v"]) * (F.col("__us") - a["t"]) / (b["t"] - a["t"])
    out = s.filter("__g = 1").select(*keys, ts, F.coalesce(F.col(value), line, a["v"]).alias(value))
    if decimals is None:
        return out
    d = attach(out, decimals, keys, seconds, ts)
    scale = F.pow(F.lit(10.0), F.col("decimals"))
    return d.withColumn(value, F.coalesce(F.round(F.col(value) * scale) / scale, F.col(value))).drop("decimals")


POLICIES = ("interp_to_finer", "interp_to_coarser", "interp_to_latest", "as_freq_finer", "as_freq_coarser", "as_freq_latest")


def target_freq(freqs: list[tuple[int, int | None]], policy: str | None) -> int | None:
    """TIM-5.  Step to use for parts given as (order, step seconds); the last
    part in order is the latest.  Equal steps need no policy."""
    steps = [s for _, s in freqs if s is not None]
    if not steps or len(set(steps)) == 1 and len(steps) == len(freqs):
        return steps[0] if steps else None
    if policy is None:
        raise ValueError(f"mixed frequencies {sorted(set(steps))} and no policy")
    if policy.isdigit():
        return int(policy)
    if policy not in POLICIES:
        raise ValueError(f"unknown frequency policy {policy}")
    which = policy.rsplit("_", 1)[1]
    if which == "finer":
        return min(steps)
    if which == "coarser":
        return max(steps)
    return [s for _, s in sorted(freqs, key=lambda f: f[0]) if s is not None][-1]


def freq_choice(freqs: DataFrame, keys, policy: str | None, order="part") -> DataFrame:
    """TIM-5 for all series at once.  ``freqs``: keys, part, freq.  One row per
    series: the step to use and whether the parts differ."""
    agg = freqs.groupBy(*keys).agg(
        F.min("freq").alias("finer"), F.max("freq").alias("coarser"),
        F.max_by("freq", F.when(F.col("freq").isNotNull(), F.col(order))).alias("latest"),
        (F.countDistinct("freq") > 1).alias("mixed"))
    if policy is None:
        pick = F.when(F.col("mixed"), F.raise_error(F.lit("mixed frequencies and no policy")).cast("long")).otherwise(F.col("finer"))
    elif policy.isdigit():
        pick = F.lit(int(policy)).cast("long")
    elif policy in POLICIES:
        pick = F.col(policy.rsplit("_", 1)[1])
    else:
        raise ValueError(f"unknown frequency policy {policy}")
    return agg.select(*keys, pick.alias("freq"), "mixed")


def resolve_freq(df, keys, freqs: DataFrame, policy: str | None, steps: tuple[int, ...], part="part",
                 value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-5.  Bring every part of every series to the step of its series.

    ``steps``: the steps that occur, known from ``freqs``; one grid operation
    per step over all the series that use it.
    """
    choice = freq_choice(freqs, keys, policy, part)
    tagged = attach(df, choice.select(*keys, "freq"), keys, seconds, ts)
    parts = []
    for s in steps:
        sub = tagged.filter(F.col("freq") == s).drop("freq")
        if policy and policy.startswith("interp"):
            parts.append(interp_to(sub, [*keys, part], s, value=value, ts=ts, seconds=seconds))
        else:
            parts.append(asfreq(sub, [*keys, part], s, (value,), ts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingest_policy(earlier: int, later: int) -> tuple[str, str]:
    """TIM-6.  How a series whose step changed at ingest is brought to one step."""
    minute, hour, day = 60, 3600, 86400
    if (earlier, later) == (hour, 6 * minute):
        return ("asfreq", "finer")
    if later == 15 * minute and earlier in (10 * minute, 20 * minute):
        return ("interp", "latest")
    if (earlier, later) == (hour, 15 * minute):
        return ("interp", "finer")
    if {earlier, later} in ({hour, day}, {15 * minute, day}):
        return ("asfreq", "coarser")
    raise ValueError(f"no rule for a step change from {earlier} s to {later} s")


def ingest_policy_column(earlier: Column, later: Column) -> Column:
    """TIM-6 as a Column: ``method:which``, an error for a transition without rule."""
    text = F.raise_error(F.concat(F.lit("no rule for step change "), earlier.cast("string"), F.lit(" to "), later.cast("string"))).cast("string")
    out = F.when(earlier == later, F.lit("asfreq:same"))
    for a in (600, 900, 1200, 3600, 86400):
        for b in (360, 900, 3600, 86400):
            if a != b:
                try:
                    method, which = ingest_policy(a, b)
                except ValueError:
                    continue
                out = out.when((earlier == a) & (later == b), F.lit(f"{method}:{which}"))
    return out.otherwise(text)


TARGETS = ("finer", "coarser", "latest")


def parse_policy(policy: str | None) -> tuple[str, str] | None:
    """TIM-5.  (method, target) of ``interp_to_finer`` ..., or of ``interp:900`` and
    ``asfreq:900``, which name the step in seconds."""
    if policy is None:
        return None
    if ":" in policy:
        method, target = policy.split(":", 1)
    else:
        head, _, target = policy.rpartition("_")
        method = {"interp_to": "interp", "as_freq": "asfreq"}.get(head, "")
    if method not in ("interp", "asfreq") or not (target in TARGETS or target.isdigit() and int(target) > 0):
        raise ValueError(f"unknown frequency policy {policy}")
    return method, target


def freq_plan(freqs: DataFrame, keys, policy: str | None, order="part") -> DataFrame:
    """TIM-5 as rows: (keys, freq, method, problem), one for each series.

    ``freqs``: keys, part, freq.  A series whose parts have one step, or are all
    irregular, stays as it is: ``freq`` is NULL.  Where they differ, ``freq`` is the
    step to use; a series that the policy cannot bring to one step has a ``problem``."""
    how = parse_policy(policy)
    agg = freqs.groupBy(*keys).agg(
        F.min("freq").alias("finer"), F.max("freq").alias("coarser"), F.max_by("freq", order).alias("latest"),
        (F.countDistinct("freq") + F.max(F.col("freq").isNull().cast("int"))).alias("__kinds"), F.max(F.col("freq").isNull()).alias("__odd"))
    mixed = F.col("__kinds") > 1
    problem = F.when(mixed & F.lit(how is None), "mixed frequencies and no policy")
    target = F.lit(None).cast("long")
    if how is not None:
        method, which = how
        if which in TARGETS:
            problem = problem.when(mixed & F.col("__odd"), "mixed frequencies of which one is irregular")
            target = F.col(which)
        else:
            target = F.lit(int(which)).cast("long")
    return agg.select(*keys, F.when(mixed & problem.isNull(), target).alias("freq"), F.lit(how[0] if how else None).cast("string").alias("method"), problem.alias("problem"))


def ingest_plan(freqs: DataFrame, keys, order="file") -> DataFrame:
    """TIM-6 for all series: (keys, freq, method, problem) by the distinct steps of a
    series' files, in the order in which they first appear."""
    first = freqs.groupBy(*keys, "freq").agg(F.min(order).alias("__o"))
    steps = first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("__o", "freq"))), lambda x: x["freq"]).alias("__steps"))
    n, a, b = F.size("__steps"), F.try_element_at("__steps", F.lit(1)), F.try_element_at("__steps", F.lit(2))
    rule = F.lit(None).cast("string")
    for x in (600, 900, 1200, 3600, 86400):
        for y in (360, 900, 3600, 86400):
            if x != y:
                try:
                    method, which = ingest_policy(x, y)
                except ValueError:
                    continue
                rule = F.when((a == x) & (b == y), F.lit(f"{method}:{which}")).otherwise(rule)
    rule = F.when(n == 2, rule)
    which = F.split(rule, ":")[1]
    target = F.when(which == "finer", F.least(a, b)).when(which == "coarser", F.greatest(a, b)).when(which == "latest", b)
    text = F.array_join(F.transform("__steps", lambda x: F.coalesce(x.cast("string"), F.lit("irregular"))), ",")
    problem = F.when((n == 1) & a.isNull(), F.lit("irregular files")).when((n > 1) & rule.isNull(), F.concat(F.lit("no rule for the steps "), text))
    return steps.select(*keys, target.alias("freq"), F.split(rule, ":")[0].alias("method"), problem.alias("problem"))


def on_steps(df, keys, facts: DataFrame, value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-5.  Every series on the grid of its own step, all in one plan.

    ``facts``: by some of the keys (freq, method) and, if interpolated values are to be
    rounded, decimals.  ``asfreq`` takes the values that stand on a grid from the first
    time of the series, ``interp`` a line in time on the whole steps around it, and
    rows of a series without ``freq`` stay.  The step is a column: grids of different
    steps are made by the same blocks and meet the rows in the same aggregation."""
    by = [k for k in keys if k in facts.columns]
    rounds = "decimals" in facts.columns
    carried = ["freq", "method", *(["decimals"] if rounds else [])]
    tagged = attach(df.select(*keys, ts, F.col(value).cast("double").alias(value)), facts.select(*by, *carried), by, seconds, ts)
    stay = tagged.filter("freq IS NULL").select(*keys, ts, value)
    step, line = F.col("freq") * MICROS, F.col("method") == "interp"
    d = tagged.filter("freq IS NOT NULL").select(*keys, *carried, micros(ts).alias("__us"), value)
    spans = summarize(d, [*keys, *carried], [F.min("__us").alias("__a"), F.max("__us").alias("__b")])
    spans = spans.withColumn("__t0", F.when(line, 0).otherwise(F.col("__a")).cast("long")).withColumn(
        "lo", F.floor((F.col("__a") - F.col("__t0")) / step)).withColumn("hi", F.when(line, F.ceil(F.col("__b") / step)).otherwise(F.floor((F.col("__b") - F.col("__a")) / step)))
    grid = _grid(spans, keys, GRID_BLOCK, [*carried, "__t0"]).select(
        *keys, *carried, (F.col("__t0") + F.col("__i") * step).alias("__us"), F.lit(None).cast("double").alias(value), F.lit(1).alias("__g"))
    both = d.filter(F.col(value).isNotNull()).withColumn("__g", F.lit(0)).unionByName(grid)
    one = both.groupBy(*keys, "__us").agg(F.max(value).alias(value), F.max("__g").alias("__g"), *[F.first(c).alias(c) for c in carried])
    held, ok = F.struct(F.col(value).alias("v"), F.col("__us").alias("t")), F.col(value).isNotNull()
    s = scan(one.withColumn(ts, from_micros(F.col("__us"))), keys, {"__p": prev(held, when=ok), "__q": following(held, when=ok)}, (ts,), seconds)
    p, q = F.col("__p"), F.col("__q")
    drawn = F.coalesce(F.col(value), p["v"] + (q["v"] - p["v"]) * (F.col("__us") - p["t"]) / (q["t"] - p["t"]), p["v"])
    if rounds:
        scale = F.pow(F.lit(10.0), F.col("decimals"))
        drawn = F.coalesce(F.round(drawn * scale) / scale, drawn)
    out = s.filter("__g = 1").select(*keys, ts, F.when(F.col("method") == "interp", drawn).otherwise(F.col(value)).alias(value))
    return stay.unionByName(out)


def resample_interp(df, keys, step_seconds: int, limit: int | None, value="value", ts="ts", out="filled", seconds=DEFAULT_SECONDS):
    """TIM-7.  TIM-3 grid, then WIN-1."""
    return interpolate(asfreq(df, keys, step_seconds, (value,), ts), keys, limit, value, out, (ts,), seconds)


def disaggregate(df, keys, period_seconds: int, step_seconds: int, value="value", ts="ts",
                 lowbound: float | None = None, seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-8.  Period means to sub-period means that average back exactly.

    One parabola per period (piecewise parabolic method, Colella and Woodward
    1984).  Edge values are the mean of both neighbours, limited so that the
    parabola has no new extremum; a missing neighbour gives a flat edge.  Closed
    form per period, so a period needs only its two neighbours.
    """
    n = period_seconds // step_seconds
    us = micros(ts)
    s = scan(df.select(*keys, ts, F.col(value).cast("double").alias("a")), keys, {
        "p": prev(F.struct("a", us.alias("t"))), "q": following(F.struct("a", us.alias("t")))}, (ts,), seconds)
    near = period_seconds * MICROS
    left = F.when(us - F.col("p.t") == near, (F.col("p.a") + F.col("a")) / 2)
    right = F.when(F.col("q.t") - us == near, (F.col("q.a") + F.col("a")) / 2)
    s = s.withColumn("l0", F.coalesce(left, F.col("a"))).withColumn("r0", F.coalesce(right, F.col("a")))
    if lowbound is not None:
        s = s.withColumn("l0", F.greatest("l0", F.lit(lowbound))).withColumn("r0", F.greatest("r0", F.lit(lowbound)))
    a, l0, r0 = F.col("a"), F.col("l0"), F.col("r0")
    flat = (r0 - a) * (a - l0) <= 0
    width, bend = r0 - l0, 6 * (a - (l0 + r0) / 2)
    over_l = width * bend > width * width
    over_r = width * bend < -width * width
    s = s.withColumn("l", F.when(flat, a).when(over_l, 3 * a - 2 * r0).otherwise(l0))
    s = s.withColumn("r", F.when(flat, a).when(over_r, 3 * a - 2 * l0).otherwise(r0))
    s = s.withColumn("c", 6 * (a - (F.col("l") + F.col("r")) / 2)).filter(a.isNotNull())
    j = s.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    def area(x):
        return F.col("l") * x + (F.col("r") - F.col("l")) * x * x / 2 + F.col("c") * (x * x / 2 - x * x * x / 3)

    x0, x1 = F.col("j") / n, (F.col("j") + 1) / n
    return j.select(*keys, from_micros(us + F.col("j") * F.lit(step_seconds * MICROS).cast("long")).alias(ts),
                    ((area(x1) - area(x0)) * n).alias(value))


def last_per_cell(df, keys, grid_seconds: int, value="value", ts="ts"):
    """Last valid value per grid cell, stamped with the cell start."""
    step = F.lit(grid_seconds * MICROS).cast("long")
    us = micros(ts)
    cell = us - F.pmod(us, step)
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, from_micros(cell).alias(ts)).agg(F.max_by(value, ts).alias(value))


def coarsen(df, keys, grid_seconds: int, qwidth: float, hyst=1.0, heartbeat_seconds: int | None = None,
            preserve_vals=(), original=False, value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """TIM-9.  Last value per grid cell, quantized; a row is emitted when the
    quantized value moved by more than ``hyst * qwidth`` since the last emitted
    row, a preserved value is entered or left, or the heartbeat elapsed.

    The state (last emitted time and value) runs through the series.  Chunks are
    walked in parallel from a guessed state and walked again while the state
    their predecessor ends in differs from the guess, so the result is that of
    one walk.  The walks meet at the first row both emit, so few rounds are needed.
    """
    cells = stage(chunked(last_per_cell(df, keys, grid_seconds, value, ts), keys, seconds, ts))
    fields = {f.name: f for f in cells.schema.fields}
    key_fields = [fields[k] for k in keys]
    state = [T.StructField("last_ts", T.LongType()), T.StructField("last_v", T.DoubleType())]
    schema = T.StructType([*key_fields, T.StructField(CHUNK, T.LongType()), T.StructField("us", T.LongType()),
                           T.StructField(value, T.DoubleType()), T.StructField("end", T.BooleanType()), *state])
    kept = tuple(float(v) for v in preserve_vals)
    beat = None if heartbeat_seconds is None else heartbeat_seconds * MICROS

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us")
        t_last, v_last = pdf["last_ts"].iloc[0], pdf["last_v"].iloc[0]
        t_last, v_last = (None, None) if pd.isna(t_last) else (int(t_last), float(v_last))
        rows = []
        for t, x in zip(pdf["us"].tolist(), pdf[value].tolist()):
            q = x if x in kept else round(x / qwidth) * qwidth
            moved = t_last is None or abs(q - v_last) > hyst * qwidth or (q in kept) != (v_last in kept)
            if moved or (q in kept and q != v_last) or (beat is not None and t - t_last >= beat):
                rows.append((t, x if original else q, False))
                t_last, v_last = t, q
        rows.append((None, None, True))
        out = pd.DataFrame(rows, columns=["us", value, "end"])
        out["us"] = out["us"].astype("Int64")
        for k in (*keys, CHUNK):
            out[k] = pdf[k].iloc[0]
        out["last_ts"] = pd.array([t_last] * len(out), dtype="Int64")
        out["last_v"] = v_last
        return out[[f.name for f in schema.fields]]

    chain = Window.partitionBy(*keys).orderBy(CHUNK)
    data = cells.select(*keys, CHUNK, micros(ts).alias("us"), F.col(value).cast("double").alias(value))
    chunks = cells.select(*keys, CHUNK).distinct()
    start = chunks.select("*", F.lit(None).cast("long").alias("last_ts"), F.lit(None).cast("double").alias("last_v"))
    at = [*keys, CHUNK]
    from_state = lambda s: data.join(s, at).groupBy(*at).applyInPandas(walk, schema)
    walked = stage(from_state(start))
    while True:
        ends = walked.filter("end").select(*at, "last_ts", "last_v")
        nxt = ends.select(*at, F.lag("last_ts").over(chain).alias("last_ts"), F.lag("last_v").over(chain).alias("last_v"))
        was = start.select(*at, F.col("last_ts").alias("was_ts"), F.col("last_v").alias("was_v"))
        redo = stage(nxt.join(was, at).filter(~(F.col("last_ts").eqNullSafe(F.col("was_ts")) & F.col("last_v").eqNullSafe(F.col("was_v")))).drop("was_ts", "was_v"))
        if redo.isEmpty():
            return walked.filter("NOT end").select(*keys, from_micros(F.col("us")).alias(ts), value)
        # only chunks that begin in another state than they were walked from are walked again
        others = lambda d: d.join(redo.select(*at), at, "left_anti")
        walked = stage(others(walked).unionByName(from_state(redo)))
        start = stage(others(start).unionByName(redo))


def local_to_fixed(df, keys, src_tz="America/Los_Angeles", offset_hours=-8, ts="ts", value="value", seq="seq") -> DataFrame:
    """TIM-10.  Local clock with daylight saving to a fixed offset.

    In the doubled hour the rows before the clock jumps back (in ``seq`` order)
    are daylight, those after it standard; without a visible jump, standard.  A
    time in the missing hour moves forward.  Then floor to a minute, keep first.
    """
    utc = F.to_utc_timestamp(F.col(ts).cast("timestamp"), src_tz)
    local = F.col(ts).cast("timestamp")
    hour = F.expr("INTERVAL 1 HOUR")
    a = df.withColumn("__utc", utc).withColumn("__amb", F.coalesce(F.from_utc_timestamp(utc + hour, src_tz) == local, F.lit(False)))
    # rows of a doubled hour are few: one hour per series and year
    few = a.filter("__amb").select(*keys, F.col(ts).cast("date").alias("__day"), ts, seq)
    few = chunked(few, [*keys, "__day"], by=F.floor(F.col(seq) / GRID_BLOCK))
    amb = scan(few, [*keys, "__day"], {"__p": prev(ts)}, (seq,))
    jumps = amb.filter(F.col("__p") > F.col(ts)).groupBy(*keys, "__day").agg(F.min(seq).alias("__jump"))
    # only rows of doubled hours meet their jump; the others are not moved for it
    doubled = a.filter("__amb").withColumn("__day", F.col(ts).cast("date")).join(jumps, [*keys, "__day"], "left").drop("__day")
    j = a.filter("NOT __amb").withColumn("__jump", F.lit(None).cast(df.schema[seq].dataType)).unionByName(doubled)
    late = F.col("__amb") & (F.col("__jump").isNull() | (F.col(seq) >= F.col("__jump")))
    fixed = F.when(late, F.col("__utc") + hour).otherwise(F.col("__utc")) + F.expr(f"INTERVAL '{offset_hours}' HOUR")
    m = j.withColumn("__t", F.date_trunc("minute", fixed).cast("timestamp_ntz"))
    return m.groupBy(*keys, F.col("__t").alias(ts)).agg(F.min_by(value, seq).alias(value))


def year_block(year: Column, n: int) -> Column:
    """TIM-11.  First year of the block of ``n`` years."""
    return (F.floor(year / n) * n).cast("int")


def compare_freq(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """TIM-12.  ``a`` is the source side, ``b`` the destination (keys, freq)."""
    j = a.select(*keys, F.col("freq").alias("src_freq")).join(b.select(*keys, F.col("freq").alias("dst_freq")), list(keys))
    return j.withColumn("freq_class", freq_class(F.col("src_freq"), F.col("dst_freq")))


def freq_class(src: Column, dst: Column) -> Column:
    return (F.when(src.isNull() & dst.isNull(), "both_irregular").when(src.isNull(), "src_irregular")
            .when(dst.isNull(), "dst_irregular").when(src == dst, "both_regular_same").otherwise("both_regular_different"))


def floor_to_cycle(ts, hours: int, how="floor") -> Column:
    """TIM-13.  Time of the model cycle at or before (floor) or after (ceil)."""
    step = F.lit(hours * 3600 * MICROS).cast("long")
    us = micros(ts)
    rest = F.pmod(us, step)
    down = us - rest
    return from_micros(down if how == "floor" else F.when(rest == 0, us).otherwise(down + step))
