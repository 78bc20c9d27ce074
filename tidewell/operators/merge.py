"""Combining series by priority: merge, splice, blend, overlay, comparison.

Frames come in priority order.  Merging is one aggregation by (series, ts) with
a partial aggregate before the shuffle; the time at which a splice changes
source comes from per-source first and last valid times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.operators.chunks import DEFAULT_SECONDS, attach, following, overall, prev, scan
from tidewell.operators.checks import require_empty
from tidewell.schema import MICROS, micros

PRIO = "__prio"


def stack(frames: list[DataFrame], keys, value="value", ts="ts") -> DataFrame:
    """Union of the frames with their place in the list."""
    parts = [f.select(*keys, ts, value, F.lit(i).alias(PRIO)) for i, f in enumerate(frames)]
    return reduce(DataFrame.unionByName, parts)


def concat(*frames: DataFrame) -> DataFrame:
    """SET-1."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_by_rank(df: DataFrame, keys, rank, value="value", ts="ts") -> DataFrame:
    """First valid value in rank order at each time; a time stays when all are missing."""
    r = F.col(rank) if isinstance(rank, str) else rank
    return df.groupBy(*keys, ts).agg(F.min_by(value, F.when(F.col(value).isNotNull(), r)).alias(value))


def ts_merge(frames, keys, value="value", ts="ts", strict_priority=False, seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-1; MRG-2 with ``strict_priority``."""
    return merge_ranked(stack(frames, keys, value, ts), keys, PRIO, value, ts, strict_priority, seconds)


def merge_ranked(s: DataFrame, keys, rank=PRIO, value="value", ts="ts", strict_priority=False, seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-1 and MRG-2 of a frame that carries the priority of each row, of any number."""
    if strict_priority:
        s = _outside_higher_spans(s, keys, rank, value, ts, seconds)
    return merge_by_rank(s, keys, rank, value, ts)


def covered_segments(s: DataFrame, keys, rank=PRIO, value="value", ts="ts") -> DataFrame:
    """(keys, us, top): from each time on, up to the next one, the best rank whose span
    [first valid, last valid] covers it, NULL where none does.  A series has two times at
    most for each of its ranks, so its segments are as few as its sources."""
    t = F.when(F.col(value).isNotNull(), micros(ts))
    spans = s.groupBy(*keys, rank).agg(F.min(t).alias("lo"), F.max(t).alias("hi")).filter("lo IS NOT NULL")
    held = spans.groupBy(*keys).agg(F.collect_list(F.struct("lo", "hi", F.col(rank).alias("r"))).alias("sp"))
    points = F.array_distinct(F.flatten(F.transform("sp", lambda x: F.array(x["lo"], x["hi"] + 1))))
    over = lambda p: F.array_min(F.transform(F.filter("sp", lambda x: (x["lo"] <= p) & (p <= x["hi"])), lambda x: x["r"]))
    return held.select(*keys, F.explode(F.transform(points, lambda p: F.struct(p.alias("us"), over(p).alias("top")))).alias("e")).select(*keys, "e.us", "e.top")


def _outside_higher_spans(s, keys, rank, value, ts, seconds):
    """Drop rows inside [first valid, last valid] of any higher priority.  The segments
    stand among the rows, and each row looks back to the last one before it."""
    cols = s.columns
    rows = s.select(*cols, F.lit(1).alias("__o"), F.lit(None).cast(s.schema[rank].dataType).alias("__top"))
    cut = covered_segments(s, keys, rank, value, ts).withColumn("__us", F.col("us"))
    cut = cut.select(*[F.timestamp_micros("__us").cast(s.schema[ts].dataType).alias(c) if c == ts else F.col(c) if c in keys else F.lit(None).cast(s.schema[c].dataType).alias(c) for c in cols],
                     F.lit(0).alias("__o"), F.col("top").alias("__top"))
    a = scan(rows.unionByName(cut), keys, {"__seg": prev(F.struct(F.col("__top").alias("r")), when=F.col("__o") == 0)}, (ts, "__o"), seconds)
    return a.filter((F.col("__o") == 1) & ~F.coalesce(F.col("__seg")["r"] < F.col(rank), F.lit(False))).select(*cols)


def splice_ranked(s: DataFrame, keys, n: int, prefer="first", rank=PRIO, value="value", ts="ts",
                  seconds=DEFAULT_SECONDS) -> DataFrame:
    """Splice of a frame that already carries ranks 0 .. n-1 (all columns kept)."""
    how = "max" if prefer == "first" else "min"
    specs = {f"__e{i}": overall(how, F.when((F.col(rank) == i) & F.col(value).isNotNull(), F.col(ts))) for i in range(n)}
    a = scan(s, keys, specs, (ts,), seconds)
    t, keep = F.col(ts), F.lit(False)

    def edge(fn, ids):
        cs = [F.col(f"__e{i}") for i in ids]
        return fn(*cs) if len(cs) > 1 else cs[0]

    for i in range(n):
        ok = F.col(rank) == i
        if prefer == "first":
            if i > 0:
                ok = ok & F.coalesce(t > edge(F.greatest, range(i)), F.lit(True))
            if i < n - 1:
                # ends where the next one starts, but only if a later one has data
                later = F.coalesce(*[F.col(f"__e{j}") for j in range(i + 1, n)]).isNotNull()
                ok = ok & (F.coalesce(t <= edge(F.greatest, range(i + 1)), F.lit(False)) | ~later)
        else:
            if i > 0:
                ok = ok & F.coalesce(t >= edge(F.least, range(i, n)), F.lit(False))
            if i < n - 1:
                ok = ok & F.coalesce(t < edge(F.least, range(i + 1, n)), F.lit(True))
        keep = keep | ok
    return a.filter(keep).drop(*specs)


def splice_named(df: DataFrame, keys, name: str, transition="last", value="value", ts="ts") -> DataFrame:
    """MRG-3, MRG-4 for parts that are told apart by a column, however many.

    The spans of the parts are rows, one each; what earlier and later parts leave
    to a part is a running minimum or maximum over them in name order."""
    valid = F.when(F.col(value).isNotNull(), F.col(ts))
    spans = df.groupBy(*keys, name).agg(F.min(valid).alias("__s"), F.max(valid).alias("__e"))
    up, down = Window.partitionBy(*keys).orderBy(name), Window.partitionBy(*keys).orderBy(F.desc(name))
    edge = Window.unboundedPreceding
    if transition == "last":
        here, other = F.min("__s").over(down.rowsBetween(edge, 0)), F.min("__s").over(down.rowsBetween(edge, -1))
        outer = F.row_number().over(up) == 1
        keep = lambda t: (F.col("__outer") | (t >= F.col("__here"))) & (F.col("__other").isNull() | (t < F.col("__other")))
    elif transition == "first":
        here, other = F.max("__e").over(up.rowsBetween(edge, 0)), F.max("__e").over(up.rowsBetween(edge, -1))
        outer = F.max("__e").over(up.rowsBetween(1, Window.unboundedFollowing)).isNull()  # no later part has data
        keep = lambda t: (F.col("__outer") | (t <= F.col("__here"))) & (F.col("__other").isNull() | (t > F.col("__other")))
    else:
        raise ValueError(f"unknown transition {transition}")
    limits = spans.select(*keys, name, here.alias("__here"), other.alias("__other"), outer.alias("__outer"))
    return df.join(limits, [*keys, name]).filter(keep(F.col(ts))).select(*df.columns)


def ts_splice(frames, keys, prefer="first", value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-3 (``first``): a series holds until its last valid time.  MRG-4
    (``last``): a later series takes over from its first valid time.  Gaps stay."""
    return splice_ranked(stack(frames, keys, value, ts), keys, len(frames), prefer, PRIO, value, ts, seconds).drop(PRIO)


def shard_spans(df, keys, shard="shard", value="value", ts="ts") -> DataFrame:
    ok = F.when(F.col(value).isNotNull(), F.col(ts))
    return df.groupBy(*keys, shard).agg(F.min(ok).alias("start"), F.max(ok).alias("end")).filter("start IS NOT NULL")


def shard_overlaps(df, keys, shard="shard", value="value", ts="ts") -> DataFrame:
    """MRG-5.  Neighbouring shards of a series that overlap in valid time."""
    w = Window.partitionBy(*keys).orderBy("start", shard)
    s = shard_spans(df, keys, shard, value, ts)
    return s.select(*keys, F.col(shard).alias("shard_a"), F.lead(shard).over(w).alias("shard_b"),
                    "end", F.lead("start").over(w).alias("next_start")).filter(F.col("next_start") <= F.col("end"))


def merge_shards(df, keys, shard="shard", value="value", ts="ts", check=True) -> DataFrame:
    """MRG-5.  Overlap is an error; then the newest shard wins."""
    if check:
        require_empty(shard_overlaps(df, keys, shard, value, ts), "shards overlap in time")
    return df.groupBy(*keys, ts).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(shard))).alias(value))


def latest_wins(old: DataFrame, new: DataFrame, keys, value="value", ts="ts") -> DataFrame:
    """MRG-8.  The later batch wins at each time, also with a missing value."""
    s = stack([old, new], keys, value, ts)
    return s.groupBy(*keys, ts).agg(F.max_by(value, PRIO).alias(value))


def dedupe(df, keys, seq, keep="first", columns=("value",), ts="ts") -> DataFrame:
    """MRG-9.  One row per time, the first or last in ``seq`` order."""
    pick = F.min_by if keep == "first" else F.max_by
    return df.groupBy(*keys, ts).agg(*[pick(c, seq).alias(c) for c in columns])


def overlay(base, other, keys, value="value", ts="ts") -> DataFrame:
    """MRG-10.  ``other`` wins where valid, only at the times of ``base``."""
    s = stack([base, other], keys, value, ts)
    return s.groupBy(*keys, ts).agg(
        F.max(F.when(F.col(PRIO) == 0, 1)).alias("__in"),
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(PRIO))).alias(value)).filter("__in = 1").drop("__in")


def fill_from(*columns) -> Column:
    """MRG-11.  Ordered cascade: the first column that has a value."""
    return F.coalesce(*columns)


def ts_blend(primary, secondary, keys, length_seconds: int, value="value", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-12.  ``secondary`` fills the gaps of ``primary``, shifted near a gap
    edge by the misfit there, with a weight that falls linearly from 1 at the
    edge to 0 after ``length`` (or at the other edge, if that is closer)."""
    s = stack([primary, secondary], keys, value, ts)
    p = s.groupBy(*keys, ts).agg(F.max(F.when(F.col(PRIO) == 0, F.col(value))).alias("p"),
                                 F.max(F.when(F.col(PRIO) == 1, F.col(value))).alias("s"))
    edge = F.struct((F.col("p") - F.col("s")).alias("d"), micros(ts).alias("t"))
    has = F.col("p").isNotNull()
    g = scan(p, keys, {"a": prev(edge, when=has), "b": following(edge, when=has)}, (ts,), seconds)
    a, b, t = F.col("a"), F.col("b"), micros(ts)
    full = F.least(F.lit(length_seconds * MICROS).cast("long"), b["t"] - a["t"])  # least skips nulls
    wa = F.greatest(1 - (t - a["t"]) / full, F.lit(0.0))
    wb = F.greatest(1 - (b["t"] - t) / full, F.lit(0.0))
    shifted = F.col("s") + F.coalesce(wa * a["d"], F.lit(0.0)) + F.coalesce(wb * b["d"], F.lit(0.0))
    return g.select(*keys, ts, F.coalesce(F.col("p"), shifted).alias(value))


def check_slices(rules: DataFrame, files: DataFrame, keys, file="file") -> DataFrame:
    """MRG-13.  Violations of slice rules (keys, file, include, start, target)
    against the known files (keys, file)."""
    k = [*keys, file]
    clash = rules.groupBy(*k).agg(F.countDistinct("include").alias("n")).filter("n > 1").select(*k, F.lit("include_omit_clash").alias("problem"))
    uncovered = files.select(*k).distinct().join(rules.select(*k), k, "left_anti").select(*k, F.lit("not_covered").alias("problem"))
    w = Window.partitionBy(*keys).orderBy("ord")
    inc = rules.filter("include")
    starts = inc.withColumn("next_start", F.lead("start").over(w)).filter(F.col("next_start") <= F.col("start")).select(*k, F.lit("empty_slice").alias("problem"))
    names = inc.groupBy(*keys, "target").agg(F.count(F.lit(1)).alias("n"), F.min(file).alias(file)).filter("n > 1").select(*k, F.lit("name_collision").alias("problem"))
    return clash.unionByName(uncovered).unionByName(starts).unionByName(names)


def partition_slices(df, rules, keys, file="file", ts="ts", seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-13.  Rows of the k-th included file in ``[start_k, start_{k+1})``."""
    w = Window.partitionBy(*keys).orderBy("ord")
    r = rules.filter("include").select(*keys, file, "target", F.col("start").alias("__from"), F.lead("start").over(w).alias("__to"))
    a = attach(df, r, [*keys, file], seconds, ts)
    t = F.col(ts)
    return a.filter(F.col("target").isNotNull() & (t >= F.col("__from")) & (F.col("__to").isNull() | (t < F.col("__to")))).drop("__from", "__to")


def merge_files(kind: str, frames, keys, order="first", value="value", ts="ts") -> DataFrame:
    """MRG-14.  ``kind`` merge or splice; ``order`` tells which end of the list
    has priority."""
    if kind == "merge":
        return ts_merge(frames if order == "first" else frames[::-1], keys, value, ts)
    if kind == "splice":
        return ts_splice(frames, keys, order, value, ts)
    raise ValueError(f"unknown kind {kind}")


# --- set comparison ----------------------------------------------------------

def index_difference(staged, repo, keys, ts="ts", value=None) -> DataFrame:
    """SET-3.  Counts of common, staged-only and repo-only times per series."""
    s = staged.select(*keys, ts, F.lit(1).alias("s"), F.lit(0).alias("r"))
    r = repo.select(*keys, ts, F.lit(0).alias("s"), F.lit(1).alias("r"))
    t = s.unionByName(r).groupBy(*keys, ts).agg(F.max("s").alias("s"), F.max("r").alias("r"))
    return t.groupBy(*keys).agg(F.count_if((F.col("s") == 1) & (F.col("r") == 1)).alias("common"),
                                F.count_if(F.col("r") == 0).alias("staged_only"), F.count_if(F.col("s") == 0).alias("repo_only"))


def compare_catalogs(base, comp, name="file", two_year=False, exceptions: dict | None = None) -> DataFrame:
    """SET-2.  (name, other, match): ``same``, ``near`` (equal but for the last
    four characters of the stem, for two-year suffixes), ``base_only``,
    ``comp_only``.  ``exceptions``: patterns per side that are not reported."""
    exceptions = exceptions or {}
    b, c = base.select(F.col(name).alias("b")).distinct(), comp.select(F.col(name).alias("c")).distinct()
    full = b.join(c, F.col("b") == F.col("c"), "full")
    same = full.filter("b IS NOT NULL AND c IS NOT NULL").select(F.col("b").alias("name"), F.col("c").alias("other"), F.lit("same").alias("match"))
    ob, oc = full.filter("c IS NULL").select("b"), full.filter("b IS NULL").select("c")

    near = None
    if two_year:
        ob = ob.withColumn("k", F.expr("substr(regexp_replace(b, '[.][^.]*$', ''), 1, greatest(length(regexp_replace(b, '[.][^.]*$', '')) - 4, 0))"))
        oc = oc.withColumn("k", F.expr("substr(regexp_replace(c, '[.][^.]*$', ''), 1, greatest(length(regexp_replace(c, '[.][^.]*$', '')) - 4, 0))"))
        of_c, of_b = oc.groupBy("k").agg(F.max("c").alias("other")), ob.select("k").distinct()
        near = ob.join(of_c, "k").select(F.col("b").alias("name"), "other", F.lit("near").alias("match"))
        ob, oc = ob.join(of_c, "k", "left_anti"), oc.join(of_b, "k", "left_anti")
    for side, pats in exceptions.items():
        for p in pats:
            if side == "base":
                ob = ob.filter(~F.col("b").rlike(p))
            else:
                oc = oc.filter(~F.col("c").rlike(p))
    none = F.lit(None).cast("string").alias("other")
    out = same.unionByName(ob.select(F.col("b").alias("name"), none, F.lit("base_only").alias("match")))
    out = out.unionByName(oc.select(F.col("c").alias("name"), none, F.lit("comp_only").alias("match")))
    return out.unionByName(near) if near is not None else out
