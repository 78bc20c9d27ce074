"""SCR-11.  Screening of a repository from keyed read to written shards, with failures as rows."""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.checks import set_aside
from tidewell.operators.chunks import DEFAULT_SECONDS
from tidewell.operators.screen import METHODS, auto_screen, label_of, placed_inventory, protocols
from tidewell.plans.series import collect_series
from tidewell.session import stage
from tidewell.sources.shards import write_shards


def step_problem(step: dict) -> str | None:
    """Why a protocol step cannot run: an unknown method, or arguments it does not take."""
    method, args = step.get("method"), step.get("args", {})
    if method not in METHODS:
        return f"unknown method {method}"
    known = list(inspect.signature(METHODS[method]).parameters.values())[5:]
    odd = sorted(set(args) - {p.name for p in known})
    if odd:
        return f"{label_of(step)} does not take {', '.join(odd)}"
    lacking = [p.name for p in known if p.default is inspect.Parameter.empty and p.name not in args]
    if lacking:
        return f"{label_of(step)} needs {', '.join(lacking)}"
    for name, value in args.items():
        like = next(p.default for p in known if p.name == name)
        if isinstance(like, tuple) and not (isinstance(value, (list, tuple)) and len(value) == len(like) and all(x is None or _is_number(x) for x in value)):
            return f"{label_of(step)}: {name} must hold {len(like)} numbers"
        if _is_number(like) and not _is_number(value):
            return f"{label_of(step)}: {name} must be a number"
    return None


def _is_number(x) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def protocol_problems(config: dict) -> list[tuple[str, str, str, str]]:
    """(station, param, region, problem) of the protocols that cannot run, as many as the
    configuration has entries at most."""
    found = []
    for *at, steps in protocols(config):
        why = next(filter(None, map(step_problem, steps)), None)
        if why:
            found.append((*at, why))
    return found


def runnable(config: dict, bad: list[tuple[str, str, str, str]]) -> dict:
    """The configuration without the steps that cannot run; their series are set aside before."""
    if not bad:
        return config

    def kept(level: dict) -> dict:
        out = dict(level)
        for part in ("steps", "add_steps", "modify_steps"):
            if isinstance(out.get(part), list):
                out[part] = [s for s in out[part] if step_problem(s) is None]
        return out
    params = lambda d: {p: kept(v) for p, v in d.items()}
    places = lambda d: {n: {**v, "params": params(v.get("params", {}))} for n, v in d.items()}
    defaults = {**config["defaults"], "global": kept(config["defaults"]["global"]), "params": params(config["defaults"].get("params", {}))}
    return {**config, "defaults": defaults, "regions": places(config.get("regions", {})), "stations": places(config.get("stations", {}))}


def screen_repository(obs: DataFrame, order: DataFrame, n_prio: int, config: dict, inventory: DataFrame, keys=("station", "param"),
                      policy: str | None = "as_freq_finer", path: str | None = None, seconds=DEFAULT_SECONDS, shard="shard") -> tuple[DataFrame, DataFrame]:
    """SCR-11.  Read, resolve, screen and write every series of the inventory.

    ``obs``: keys, provider, shard, ts, value.  ``inventory``: station, param, region.
    Returns (rows (keys, ts, value, user_flag), failures (keys, problem)): a series
    whose shards overlap, whose steps cannot be settled, that has no data or whose
    protocol cannot run is a row of the second, and all others are screened in one plan.
    With a ``path`` the flagged rows are written as year shards."""
    keys = list(keys)
    listed = inventory.dropDuplicates(keys)
    spark = obs.sparkSession
    bad = protocol_problems(config)
    refused = placed_inventory(listed, config).join(
        F.broadcast(spark.createDataFrame(bad, "__s string, __p string, __r string, problem string")), ["__s", "__p", "__r"]).select(*keys, "problem")  # as small as the configuration
    wanted = obs.join(listed.select(*keys), keys, "left_semi")
    have = wanted.filter(F.col("value").isNotNull()).select(*keys).distinct()
    empty = listed.select(*keys).join(have, keys, "left_anti").withColumn("problem", F.lit("no data found"))
    rows, unread = collect_series(set_aside(wanted, refused, keys), keys, order, n_prio, policy=policy, shard=shard, seconds=seconds)
    # the tests read the rows again and again: they are made once
    flagged = auto_screen(stage(rows), runnable(config, bad), listed, keys, seconds)
    failures = refused.unionByName(empty).unionByName(unread).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("problem")), "; ").alias("problem"))
    if path is not None:
        flagged = stage(flagged)
        write_shards(flagged, path, keys)
    return flagged, failures
