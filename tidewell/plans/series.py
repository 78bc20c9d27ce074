"""MRG-6 and MRG-7.  The keyed read: all requested series in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.aggs import series_decimals
from tidewell.operators.checks import require_empty, set_aside
from tidewell.operators.chunks import DEFAULT_SECONDS
from tidewell.operators.filters import slice_time
from tidewell.operators.grid import freq_plan, infer_freq, on_steps, parse_policy
from tidewell.operators.merge import PRIO, concat, merge_by_rank, merge_shards, shard_overlaps, splice_ranked
from tidewell.session import stage


def read_series(obs: DataFrame, keys, order: DataFrame, n_prio: int, start=None, end=None, policy: str | None = None,
                shard="shard", check=True, seconds=DEFAULT_SECONDS) -> DataFrame:
    """MRG-6.  Provider order, merge of the shards of each provider (newest first,
    overlap is an error), one step, splice of the providers (first holds), slice.

    ``obs``: keys, provider, shard, ts, value.  ``order``: first key, provider,
    prio from 0 to ``n_prio - 1`` (see ``provider_order``).  Providers without a
    place in the order are not read.  The time range reaches the scan only for
    whole shards, because a splice looks at the last valid time of a provider.
    Without a policy the steps of the providers are not looked at.
    """
    ranked = _ranked(obs, keys, order)
    per = merge_shards(ranked, [*keys, PRIO], shard, check=check)
    if policy is not None:
        per = stage(per)  # read for its steps, its decimals and its values
        plan = _step_plan(per, keys, policy, seconds)
        require_empty(plan.filter("problem IS NOT NULL").select(*keys, "problem"), "frequencies of providers")
        per = on_steps(per, [*keys, PRIO], plan, seconds=seconds)
    return _spliced(per, keys, n_prio, start, end, seconds)


def collect_series(obs: DataFrame, keys, order: DataFrame, n_prio: int, start=None, end=None, policy: str | None = None,
                   shard="shard", seconds=DEFAULT_SECONDS) -> tuple[DataFrame, DataFrame]:
    """MRG-6 that goes on: (rows, failures (keys, problem)).  Series whose shards
    overlap, or whose steps the policy cannot settle, are set aside."""
    ranked = _ranked(obs, keys, order)
    clash = shard_overlaps(ranked, [*keys, PRIO], shard).select(*keys).distinct().withColumn("problem", F.lit("shards overlap in time"))
    clash = stage(clash)
    per = merge_shards(set_aside(ranked, clash, keys), [*keys, PRIO], shard, check=False)
    failed = clash
    if policy is not None:
        per = stage(per)
        plan = _step_plan(per, keys, policy, seconds)
        odd = plan.filter("problem IS NOT NULL").select(*keys, "problem")
        per = on_steps(set_aside(per, odd, keys), [*keys, PRIO], plan, seconds=seconds)
        failed = failed.unionByName(odd)
    return _spliced(per, keys, n_prio, start, end, seconds), failed


def _ranked(obs, keys, order):
    st = keys[0]
    return obs.join(order.select(st, "provider", F.col("prio").alias(PRIO)), [st, "provider"])


def _step_plan(per, keys, policy, seconds):
    """What to do with each series, by rows: nothing returns to the driver."""
    parts = infer_freq(per, [*keys, PRIO], seconds=seconds).select(*keys, PRIO, "freq")
    plan = freq_plan(parts, keys, policy, PRIO)
    if parse_policy(policy)[0] != "interp":
        return stage(plan)
    # interpolated values are rounded as the provider writes its own
    return stage(parts.select(*keys, PRIO).join(plan, list(keys)).join(series_decimals(per, [*keys, PRIO]), [*keys, PRIO], "left"))


def _spliced(per, keys, n_prio, start, end, seconds):
    spliced = splice_ranked(per, keys, n_prio, "first", PRIO, seconds=seconds).drop(PRIO)
    return slice_time(spliced, start, end).select(*keys, "ts", "value")


def first_headers(meta: DataFrame, keys, header="header", file="file") -> DataFrame:
    """MRG-6.  Header of the first file of each (series, provider)."""
    return meta.groupBy(*keys, "provider").agg(F.min_by(header, file).alias(header))


def read_series_multi(obs: DataFrame, keys, sources: list[tuple[Column, Callable[[DataFrame], DataFrame] | None]]) -> DataFrame:
    """MRG-7.  Each source is a filter with its own transform; merged in order."""
    parts = []
    for i, (which, fn) in enumerate(sources):
        d = obs.filter(which)
        d = fn(d) if fn is not None else d
        parts.append(d.select(*keys, "ts", "value", F.lit(i).alias(PRIO)))
    return merge_by_rank(concat(*parts), keys, PRIO)
