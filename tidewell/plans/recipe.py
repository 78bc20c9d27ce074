"""PRD-16.  Ingest recipes: collect, transform, describe, stage, reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.functions.scalars import add_column, convert_units, linear
from tidewell.operators.checks import require_empty
from tidewell.operators.filters import trim_edges
from tidewell.operators.grid import coarsen, local_to_fixed
from tidewell.operators.merge import shard_overlaps, splice_named
from tidewell.operators.windows import bfill, ffill, fill_sweep
from tidewell.plans.steps import apply_transform, register_transform

KEY = ["entry"]

register_transform("convert_units", lambda df, from_unit, to_unit: df.withColumn("value", convert_units("value", from_unit, to_unit)))
register_transform("linear", lambda df, scale=1.0, offset=0.0: df.withColumn("value", linear("value", scale, offset)))
register_transform("add_column", lambda df, name, default=None, dtype="string": add_column(df, name, default, dtype))
register_transform("trim_edges", lambda df, side="both", criterion="all": trim_edges(df, KEY, ("value",), side, criterion))
register_transform("coarsen", lambda df, grid_seconds, qwidth, hyst=1.0, heartbeat_seconds=None, preserve_vals=():
                   coarsen(df, KEY, grid_seconds, qwidth, hyst, heartbeat_seconds, preserve_vals))
register_transform("dst_to_fixed", lambda df, src_tz, offset_hours=-8:
                   local_to_fixed(df.withColumn("__seq", F.unix_micros(F.col("ts").cast("timestamp"))), KEY, src_tz, offset_hours, seq="__seq"))


@register_transform("fill")
def _fill(df, method="ffill", limit=None):
    fn = {"ffill": ffill, "bfill": bfill, "sweep": fill_sweep}[method]
    return fn(df, KEY, limit).withColumn("value", F.col("filled")).drop("filled")


def glob_pattern(wildcard: str) -> str:
    import fnmatch
    return fnmatch.translate(wildcard).replace("\\Z", "$").replace("\\z", "$")


def collect_files(files: DataFrame, spec: dict) -> DataFrame:
    """Rows of the files an entry names, as one series (entry, ts, value).

    mode ``none``: exactly one file; ``time_shard``: files that do not overlap;
    ``time_overlap``: combined by ``merge`` or ``splice``, later names last.
    """
    mode = spec.get("mode", "none")
    d = files.filter(F.col("file").rlike(glob_pattern(spec["pattern"]))).withColumn("entry", F.lit(spec["name"]))
    found = d.select("file").distinct()
    n = found.count()
    if n == 0:
        raise ValueError(f"no file matches {spec['pattern']}")
    if mode == "none":
        if n > 1:
            raise ValueError(f"{spec['pattern']} matches {n} files, one expected")
        return d.select("entry", "ts", "value")
    if mode == "time_shard":
        require_empty(shard_overlaps(d, KEY, "file"), "files overlap in time")
        return d.select("entry", "ts", "value")
    if mode != "time_overlap":
        raise ValueError(f"unknown mode {mode}")
    first = spec.get("priority", "last") == "first"
    if spec.get("combine", "splice") == "merge":
        pick = F.min_by if first else F.max_by
        return d.groupBy("entry", "ts").agg(pick("value", F.when(F.col("value").isNotNull(), F.col("file"))).alias("value"))
    return splice_named(d.select("entry", "file", "ts", "value"), KEY, "file", "first" if first else "last").drop("file")


def run_entry(files: DataFrame, spec: dict) -> DataFrame:
    """Collect, then the transforms in order, then the metadata columns."""
    d = collect_files(files, spec)
    for t in spec.get("transforms", []):
        d = apply_transform(d, t["name"], t.get("args"))
    for k, v in spec.get("metadata", {}).items():
        d = d.withColumn(k, F.lit(v))
    return d


def ingest(files: DataFrame, recipes: list[dict], sink=None, reconcile=None) -> dict[str, DataFrame]:
    """PRD-16.  Run all entries.  ``sink(name, df)`` stages an entry and
    ``reconcile(name, df)`` updates the repository.  A failed entry does not stop
    the others; the run fails at the end with all failures."""
    done, failed = {}, {}
    for spec in recipes:
        try:
            d = run_entry(files, spec)
            if sink is not None:
                sink(spec["name"], d)
            if reconcile is not None and spec.get("reconcile"):
                reconcile(spec["name"], d)
            done[spec["name"]] = d
        except Exception as e:  # reported together below
            failed[spec["name"]] = str(e)
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(recipes)} entries failed: {failed}")
    return done
