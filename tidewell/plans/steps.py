"""UDF-1, PRD-17.  Named DataFrame steps that users add to recipes."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

_STEPS: dict[str, Callable] = {}


def register_transform(name: str, fn: Callable | None = None):
    """UDF-1.  Add ``fn(df, **args) -> DataFrame``; also usable as a decorator."""
    def add(f):
        if name in _STEPS:
            raise ValueError(f"transform {name} exists")
        _STEPS[name] = f
        return f
    return add(fn) if fn is not None else add


def apply_transform(df: DataFrame, name: str, args: dict | None = None) -> DataFrame:
    if name not in _STEPS:
        raise ValueError(f"unknown transform {name}; known: {sorted(_STEPS)}")
    args = args or {}
    try:
        inspect.signature(_STEPS[name]).bind(df, **args)
    except TypeError as e:
        raise ValueError(f"transform {name}: {e}") from e
    return df.transform(lambda d: _STEPS[name](d, **args))


def select_rows(df: DataFrame, column: str, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """PRD-17 for names that are data: rows of the named stations, or of all others, in one
    scan.  A name that does not occur is an error; only the asked names return."""
    asked = list(include or []) + list(exclude or [])
    if include and exclude:
        raise ValueError("include and exclude are mutually exclusive")
    if not asked:
        return df
    have = {r[0] for r in df.filter(F.col(column).isin(*asked)).select(column).distinct().collect()}
    if set(asked) - have:
        raise ValueError(f"unknown names {sorted(set(asked) - have)}")
    return df.filter(F.col(column).isin(*asked)) if include else df.filter(~F.coalesce(F.col(column).isin(*asked), F.lit(False)))


def select_steps(known: list[str], include: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """PRD-17.  Names to run, in the order known; include and exclude do not mix."""
    if include and exclude:
        raise ValueError("include and exclude are mutually exclusive")
    bad = [n for n in (include or []) + (exclude or []) if n not in known]
    if bad:
        raise ValueError(f"unknown names {bad}")
    if include:
        return [n for n in known if n in include]
    return [n for n in known if n not in (exclude or [])]
