"""Screening: anomaly tests, protocols and the tri-state flag."""

from __future__ import annotations

import copy
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewell.operators.aggs import exact_quantiles, value_buckets
from tidewell.operators.chunks import (
    CHUNK, DEFAULT_SECONDS, attach, chunked, following, halo_blocks, overall, position, prev, scan,
)
from tidewell.operators.filters import mask_range
from tidewell.operators.windows import gap_length, good_runs_over_small_gaps, rolling_median, run_length


def apply_flags(value="value", flag="user_flag") -> Column:
    """SCR-12.  NULL where the flag says anomaly."""
    return F.when(F.coalesce(F.col(flag) != 1, F.lit(True)), F.col(value))


# Each test: (df, keys, out, value, seconds, **args) -> df with a boolean column
# ``out``.  Missing values are never anomalous.

def bounds_test(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, bounds=(None, None)):
    """SCR-1."""
    return df.withColumn(out, F.col(value).isNotNull() & mask_range(value, *bounds).isNull())


def repeat_test(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, max_repeat=100, lower_limit=None, upper_limit=None):
    """SCR-2.  Runs of equal values longer than ``max_repeat``."""
    r = run_length(df, keys, value, "__run", ("ts",), seconds, keep_chunk=CHUNK in df.columns)
    hit = F.col("__run") > max_repeat
    if lower_limit is not None:
        hit = hit & (F.col(value) > lower_limit)
    if upper_limit is not None:
        hit = hit & (F.col(value) < upper_limit)
    return r.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__run")


def short_run_test(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, small_gap_len=0, min_run_len=2):
    """SCR-3.  Good runs shorter than ``min_run_len`` once small gaps are filled."""
    r = good_runs_over_small_gaps(df, keys, small_gap_len, value, "__run", ("ts",), seconds, CHUNK in df.columns)
    return r.withColumn(out, F.col(value).isNotNull() & (F.col("__run") < min_run_len)).drop("__run")


def dip_test(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, low=0.0, dip=1.0):
    """SCR-4.  Below ``low`` with both neighbours higher by ``dip`` or missing."""
    s = scan(df, keys, {"__p": prev(F.struct(F.col(value).alias("v"))), "__q": following(F.struct(F.col(value).alias("v")))},
             ("ts",), seconds, CHUNK in df.columns)
    far = lambda n: F.col(n)["v"].isNull() | (F.col(n)["v"] - F.col(value) > dip)
    hit = (F.col(value) < low) & F.col("__p").isNotNull() & F.col("__q").isNotNull() & far("__p") & far("__q")
    return s.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__p", "__q")


def median_residual(df, keys, filt_len, align, value="value", seconds=DEFAULT_SECONDS, out="residual"):
    r = rolling_median(df, keys, filt_len, align, value, "__med", ("ts",), seconds)
    return r.withColumn(out, F.col(value) - F.col("__med")).drop("__med")


def _median_test(df, keys, out, value, seconds, level, filt_len, quantiles, align, min_scale=0.0):
    keep = CHUNK in df.columns
    r = median_residual(df.select(*keys, "ts", value), keys, filt_len, align, value, seconds, "__res")
    q = exact_quantiles(r, keys, {"__qlo": quantiles[0], "__qhi": quantiles[1]}, "__res")
    width = q.select(*keys, F.greatest(F.col("__qhi") - F.col("__qlo"), F.lit(float(min_scale))).alias("__scale"))
    a = attach(r, width, keys, seconds, keep_chunk=keep)
    return a.withColumn(out, F.coalesce(F.abs("__res") > level * F.col("__scale"), F.lit(False))).drop("__res", "__scale")


def median_test_twoside(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, level=4, filt_len=7, quantiles=(0.01, 0.99)):
    """SCR-5.  Distance to the centred rolling median above ``level`` times the
    quantile range of the distances of the series."""
    return _median_test(df, keys, out, value, seconds, level, filt_len, quantiles, "center")


def median_test_oneside(df, keys, out="anomaly", value="value", seconds=DEFAULT_SECONDS, level=4, filt_len=7, quantiles=(0.01, 0.99), reverse=False):
    """SCR-6.  Same against the ``filt_len`` rows before (after, if reversed)."""
    return _median_test(df, keys, out, value, seconds, level, filt_len, quantiles, "after" if reverse else "before")


def med_outliers(df, keys, value="value", seconds=DEFAULT_SECONDS, level=4, scale=0.0, filt_len=7, quantiles=(0.01, 0.99), bounds=(None, None)):
    """SCR-7.  Values with outliers masked; a hard range and a minimum scale."""
    d = df.select(*keys, "ts", mask_range(value, *bounds).alias(value))
    t = _median_test(d, keys, "__hit", value, seconds, level, filt_len, quantiles, "center", scale)
    return t.withColumn(value, F.when(~F.col("__hit"), F.col(value))).drop("__hit")


def lof_scores(df, keys, k=5, value="value", block=50_000) -> DataFrame:
    """SCR-8.  Local outlier factor on the value axis (Breunig et al. 2000) per
    distinct value: (keys, value, n, lof).

    Equal values share one score, so they are counted first.  The ``k`` nearest
    values are among the ``k`` ranks on each side, and a score looks three
    neighbourhoods far, so a block of ranks with a halo of ``3k`` is enough to
    score its own values exactly.  A value needs no more than ``k + 1`` copies in
    the neighbour search: a point has only ``k`` neighbours besides itself.
    """
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias(value)).agg(F.count(F.lit(1)).alias("n"))
    ranked = scan(value_buckets(v, keys, value), keys, {"__i": position()}, (value,))
    k3 = 3 * k
    rows = halo_blocks(ranked, keys, "__i", k3, k3, max(block, 2 * k3 + 1))
    schema = T.StructType([*v.schema.fields, T.StructField("lof", T.DoubleType())])
    names = schema.fieldNames()

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i", ignore_index=True)
        copies = np.minimum(pdf["n"].to_numpy(), k + 1)
        x = np.repeat(pdf[value].to_numpy(), copies)
        n, m = len(x), min(k, len(x) - 1)
        if m < 1:
            return pdf.loc[pdf["__own"]].assign(lof=1.0)[names]
        side = np.concatenate([np.arange(-m, 0), np.arange(1, m + 1)])
        j = np.arange(n)[:, None] + side
        inside = (j >= 0) & (j < n)
        far = np.where(inside, np.abs(x[np.clip(j, 0, n - 1)] - x[:, None]), np.inf)
        near = np.argsort(far, axis=1, kind="stable")[:, :m]
        nb = np.take_along_axis(np.clip(j, 0, n - 1), near, 1)
        dist = np.take_along_axis(far, near, 1)
        reach = np.maximum(dist, dist[nb, -1])
        density = 1.0 / (reach.mean(axis=1) + 1e-10)
        lof = density[nb].mean(axis=1) / density
        pdf["lof"] = lof[np.cumsum(copies) - copies]
        return pdf.loc[pdf["__own"], names]

    return rows.groupBy(*keys, "__block").applyInPandas(score, schema)


def detect_lof(df, keys, k=5, contamination=0.02, value="value", out="anomaly", block=50_000) -> DataFrame:
    """SCR-8.  The share ``contamination`` with the highest factors is flagged."""
    s = lof_scores(df, keys, k, value, block)
    q = exact_quantiles(s.withColumn("neg", -F.col("lof")), keys, {"__cut": contamination}, "neg", weight="n")
    hits = s.join(q, list(keys)).filter(-F.col("lof") < F.col("__cut")).select(*keys, F.col(value), F.lit(True).alias(out))
    # missing values meet nothing, so they are not moved; a frequent value is split by adaptive execution
    valid = df.filter(F.col(value).isNotNull()).join(hits, [*keys, value], "left").select(*df.columns, F.coalesce(out, F.lit(False)).alias(out))
    return valid.unionByName(df.filter(F.col(value).isNull()).withColumn(out, F.lit(False)))


def remove_isolated(df, keys, thresh: int, value="value", seconds=DEFAULT_SECONDS):
    """SCR-13.  Good runs shorter than ``thresh`` rows become NULL."""
    g = gap_length(df, keys, value, "__gap", "__good", ("ts",), seconds)
    return g.withColumn(value, F.when(F.col("__good") >= thresh, F.col(value))).drop("__gap", "__good")


METHODS: dict[str, Callable] = {
    f.__name__: f for f in (bounds_test, repeat_test, short_run_test, dip_test, median_test_twoside, median_test_oneside)
}


def register_method(name: str, fn: Callable) -> None:
    """UDF-2.  Make ``fn(df, keys, out, value, seconds, **args)`` a protocol step."""
    if name in METHODS:
        raise ValueError(f"screening method {name} exists")
    METHODS[name] = fn


def label_of(step: dict) -> str:
    return step.get("label", step["method"])


def screen(df, keys, steps: list[dict], seconds=DEFAULT_SECONDS, value="value", ts="ts", labels=True) -> DataFrame:
    """SCR-9.  Run the steps; one boolean column per label and ``user_flag``.

    The rows are placed once by (series, chunk) and every step reads that
    placement.  A step gives its hits, which are few; all hits meet the rows in
    one join.  Steps after one that applies immediately see its hits as missing;
    the value column of the result is the value before screening.
    """
    unknown = [s["method"] for s in steps if s["method"] not in METHODS]
    if unknown:
        raise ValueError(f"unknown screening methods {unknown}")
    base = chunked(df.select(*keys, ts, value), keys, seconds, ts)
    work = base
    hits = []
    for step in steps:
        t = METHODS[step["method"]](work, keys, "__hit", value, seconds, **step.get("args", {}))
        hits.append(t.filter("__hit").select(*keys, ts, F.lit(label_of(step)).alias("label")))
        if step.get("apply_immediately"):
            if step["method"] == "bounds_test":
                work = t.withColumn(value, F.when(~F.col("__hit"), F.col(value))).drop("__hit")
            else:
                work = chunked(t.withColumn(value, F.when(~F.col("__hit"), F.col(value))).select(*keys, ts, value), keys, seconds, ts)
    out = base.drop(CHUNK)
    names = [label_of(s) for s in steps]
    if hits:
        wide = reduce(DataFrame.unionByName, hits).groupBy(*keys, ts).agg(
            *[F.max(F.col("label") == n).alias(n) for n in names])
        out = out.join(wide, [*keys, ts], "left")
    flags = [F.coalesce(F.col(n), F.lit(False)) for n in names]
    any_hit = reduce(lambda a, b: a | b, flags, F.lit(False))
    return out.select(*keys, ts, value, *([f.alias(n) for f, n in zip(flags, names)] if labels else []),
                      F.when(any_hit, F.lit(1)).cast("tinyint").alias("user_flag"))


# --- protocols ---------------------------------------------------------------

def edit_steps(steps: list[dict], change: dict) -> list[dict]:
    """One level of the cascade: replace the whole list, or omit, modify by
    label and append.  A list given as text "None" is absent."""
    if not change.get("inherits_global"):
        return copy.deepcopy(change["steps"])
    given = lambda k: [] if change.get(k) in (None, "None") else change[k]
    omit = set(given("omit_steps"))
    swap = {label_of(m): m for m in given("modify_steps")}
    kept = [swap.get(label_of(s), s) for s in steps if label_of(s) not in omit]
    return copy.deepcopy(kept + list(given("add_steps")))


def resolve_protocol(config: dict, station: str, param: str, region: str = "default") -> list[dict]:
    """SCR-10.  global -> param -> (region, param) -> (station, param)."""
    steps = copy.deepcopy(config["defaults"]["global"]["steps"])
    levels = [config["defaults"].get("params", {}),
              config.get("regions", {}).get(region, {}).get("params", {}),
              config.get("stations", {}).get(station, {}).get("params", {})]
    for level in levels:
        if param in level:
            steps = edit_steps(steps, level[param])
    return steps


ANY = "*"


def protocols(config: dict) -> list[tuple[str, str, str, list[dict]]]:
    """SCR-10.  Every protocol that the configuration can give, by (station, param,
    region) with ``*`` for names it does not mention together.  As many as the
    configuration has entries, whatever the inventory."""
    regions = {(r, p) for r, v in config.get("regions", {}).items() for p in v.get("params", {})}
    stations = {(st, p) for st, v in config.get("stations", {}).items() for p in v.get("params", {})}
    params = {*config["defaults"].get("params", {}), *(p for _, p in regions), *(p for _, p in stations)}
    places = [(st, p, rg) for p in params for st in [ANY, *(x for x, q in stations if q == p)] for rg in [ANY, *(x for x, q in regions if q == p)]]
    return [(*at, resolve_protocol(config, *at)) for at in sorted({(ANY, ANY, ANY), *places})]


def placed_inventory(inventory: DataFrame, config: dict) -> DataFrame:
    """Inventory rows (station, param, region) with the key of their protocol."""
    known = protocols(config)
    text = lambda parts: F.concat_ws("|", *[F.col(c) for c in parts])
    named = lambda pairs, c, by: F.when(F.array_contains(F.array(*map(F.lit, sorted(pairs))) if pairs else F.array().cast("array<string>"), by), F.col(c)).otherwise(ANY)
    return inventory.select(
        "*", named({f"{st}|{p}" for st, p, _, _ in known}, "station", text(["station", "param"])).alias("__s"),
        named({p for _, p, _, _ in known}, "param", F.col("param")).alias("__p"),
        named({f"{rg}|{p}" for _, p, rg, _ in known}, "region", text(["region", "param"])).alias("__r"))


def protocol_table(spark, config: dict, inventory: DataFrame) -> DataFrame:
    """SCR-10 as a table: one row per step of each series of the inventory
    (station, param, region).  The table of protocols is as small as the configuration."""
    rows = [(st, p, rg, i, s["method"], label_of(s), bool(s.get("apply_immediately")), {k: str(v) for k, v in s.get("args", {}).items()})
            for st, p, rg, steps in protocols(config) for i, s in enumerate(steps)]
    table = spark.createDataFrame(rows, "__s string, __p string, __r string, ord int, method string, label string, apply_immediately boolean, args map<string,string>")
    return placed_inventory(inventory, config).join(F.broadcast(table), ["__s", "__p", "__r"]).drop("__s", "__p", "__r")


def step_uses(config: dict) -> tuple[list[tuple[dict, int]], list[tuple[str, str, str, list[int]]]]:
    """Distinct (step, phase) over all protocols, and the ids each protocol uses.

    The phase of a step is the number of immediate steps before it: steps of one
    phase see the same values, so a step that many protocols share runs once."""
    ids: dict[str, int] = {}
    steps: list[tuple[dict, int]] = []
    members = []
    for *at, protocol in protocols(config):
        phase, mine = 0, []
        for step in protocol:
            key = f"{phase}{step!r}"
            if key not in ids:
                ids[key] = len(steps)
                steps.append((step, phase))
            mine.append(ids[key])
            phase += bool(step.get("apply_immediately"))
        members.append((*at, mine))
    return steps, members


def auto_screen(df, config: dict, inventory: DataFrame, keys=("station", "param"), seconds=DEFAULT_SECONDS) -> DataFrame:
    """SCR-11.  Screen every series of the inventory: (keys, ts, value, user_flag).

    ``inventory`` has the rows (station, param, region); a series meets its
    protocol by a join, so it may have any length.  The plan has one test per
    distinct step, whatever the number of series and protocols.  Bounds are tested
    in the row; the other tests give their few hits, which meet the rows in one join."""
    steps, members = step_uses(config)
    unknown = [s["method"] for s, _ in steps if s["method"] not in METHODS]
    if unknown:
        raise ValueError(f"unknown screening methods {unknown}")
    table = df.sparkSession.createDataFrame(members, "__s string, __p string, __r string, __use array<int>")
    m = placed_inventory(inventory, config).join(F.broadcast(table), ["__s", "__p", "__r"]).select("station", "param", "__use").dropDuplicates(["station", "param"])
    work = df.select(*keys, "ts", "value").join(m, ["station", "param"]).withColumn("__raw", F.col("value")).withColumn("__row", F.lit(False))
    hits: list[DataFrame] = []
    uses = lambda i: F.array_contains("__use", i)
    for phase in range(max((p for _, p in steps), default=0) + 1):
        now = [(i, s) for i, (s, p) in enumerate(steps) if p == phase]
        bounds = [(i, s) for i, s in now if s["method"] == "bounds_test"]
        out = lambda s: F.col("value").isNotNull() & mask_range("value", *s.get("args", {}).get("bounds", (None, None))).isNull()
        any_of = lambda some: reduce(lambda x, y: x | y, [uses(i) & out(s) for i, s in some], F.lit(False))
        placed = None
        instant = []
        for i, s in now:
            if s["method"] == "bounds_test":
                continue
            placed = chunked(work.select(*keys, "ts", "value", "__use"), keys, seconds) if placed is None else placed
            part = placed.filter(uses(i)).select(*keys, "ts", "value", CHUNK)
            t = METHODS[s["method"]](part, keys, "__hit", "value", seconds, **s.get("args", {})).filter("__hit").select(*keys, "ts")
            (instant if s.get("apply_immediately") else hits).append(t)
        row = work.withColumn("__row", F.col("__row") | F.coalesce(any_of(bounds), F.lit(False)))
        gone = F.coalesce(any_of([b for b in bounds if b[1].get("apply_immediately")]), F.lit(False))
        work = row.withColumn("value", F.when(~gone, F.col("value")))
        if instant:
            h = reduce(DataFrame.unionByName, instant).distinct().withColumn("__now", F.lit(True))
            j = work.join(h, [*keys, "ts"], "left").withColumn("__now", F.coalesce("__now", F.lit(False)))
            work = j.withColumn("__row", F.col("__row") | F.col("__now")).withColumn("value", F.when(~F.col("__now"), F.col("value"))).drop("__now")
    done = work.select(*keys, "ts", F.col("__raw").alias("value"), "__row")
    flag = F.col("__row")
    if hits:
        h = reduce(DataFrame.unionByName, hits).distinct().withColumn("__late", F.lit(True))
        done = done.join(h, [*keys, "ts"], "left")
        flag = flag | F.coalesce("__late", F.lit(False))
    return done.select(*keys, "ts", "value", F.when(flag, F.lit(1)).cast("tinyint").alias("user_flag"))
