"""Brute-force twins in plain Python on one small series."""

import numpy as np
import pandas as pd

SCHEMA = "station string, ts timestamp_ntz, value double"


def random_series(seed, n=240, step=3600, gaps=0.3, names=("a", "b"), digits=0):
    rng = np.random.default_rng(seed)
    out = []
    for st in names:
        ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) * step, unit="s")
        v = np.round(rng.normal(0, 2, n), digits)
        v[rng.random(n) < gaps] = np.nan
        v[30:55] = np.nan
        v[120:170] = 3
        out.append(pd.DataFrame({"station": st, "ts": ts, "value": v}))
    return pd.concat(out, ignore_index=True)


def to_spark(spark, pdf, schema=SCHEMA):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(pdf, schema)
    return d.withColumn("value", F.when(~F.isnan("value"), F.col("value"))).repartition(3)


def same(got, want, column, by=("station", "ts")):
    g = got.toPandas().sort_values(list(by)).reset_index(drop=True)
    w = want.sort_values(list(by)).reset_index(drop=True)
    assert len(g) == len(w)
    np.testing.assert_allclose(g[column].astype(float), w[column].astype(float), equal_nan=True, atol=1e-9)


def run_lengths(s, key):
    k = key(s)
    g = (k != k.shift()).cumsum()
    return g.map(g.value_counts()).astype(float)


def interpolate(values, limit):
    """First ``limit`` nulls of each run, by position; the end carries flat."""
    v, out = list(values), list(values)
    last = None
    for i, x in enumerate(v):
        if x == x:
            last = i
            continue
        if last is None or (limit is not None and i - last > limit):
            continue
        nxt = next((j for j in range(i, len(v)) if v[j] == v[j]), None)
        out[i] = v[last] if nxt is None else v[last] + (v[nxt] - v[last]) * (i - last) / (nxt - last)
    return out


def merge(frames, strict=False):
    spans = []
    out = {}
    for f in frames:
        for t, v in f:
            if strict and any(a <= t <= b for a, b in spans):
                continue
            if t not in out or (out[t] is None and v is not None):
                out[t] = v
        ok = [t for t, v in f if v is not None]
        if ok:
            spans.append((min(ok), max(ok)))
    return dict(sorted(out.items()))


def splice(frames, prefer):
    valid = [[t for t, v in f if v is not None] for f in frames]
    out = {}
    n = len(frames)
    for i, f in enumerate(frames):
        for t, v in f:
            if prefer == "first":
                done = [max(x) for x in valid[:i] if x]
                upto = [max(x) for x in valid[: i + 1] if x]
                later = any(valid[i + 1:])
                ok = (not done or t > max(done)) and (not later or (upto and t <= max(upto)))
            else:
                here = [min(x) for x in valid[i:] if x]
                after = [min(x) for x in valid[i + 1:] if x]
                ok = (i == 0 or (here and t >= min(here))) and (not after or t < min(after))
            if ok:
                out[t] = v
    return dict(sorted(out.items()))


def coarsen(rows, q, hyst, beat, keep):
    out, last = [], None
    for t, x in rows:
        v = x if x in keep else round(x / q) * q
        moved = last is None or abs(v - last[1]) > hyst * q or (v in keep) != (last[1] in keep)
        if moved or (beat is not None and t - last[0] >= beat):
            out.append((t, v))
            last = (t, v)
    return out


def regularize(rows, step):
    best = {}
    for us, v in rows:
        q, r = divmod(us, step)
        i = q + (1 if 2 * r > step or (2 * r == step and q % 2) else 0)
        rank = (v is None, abs(us - i * step), us)
        if i not in best or rank < best[i][0]:
            best[i] = (rank, v)
    return {i: best[i][1] if i in best else None for i in range(min(best), max(best) + 1)}


def make(spark, rows, schema):
    """createDataFrame that takes pandas timestamps inside tuples."""
    if isinstance(rows, pd.DataFrame):
        return spark.createDataFrame(rows, schema)
    plain = lambda x: x.to_pydatetime() if isinstance(x, pd.Timestamp) else x
    return spark.createDataFrame([tuple(plain(x) for x in r) for r in rows], schema)
