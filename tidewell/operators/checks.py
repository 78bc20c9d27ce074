"""Checks that stop a run, and rows set aside without stopping it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def require_empty(bad: DataFrame, what: str, show: int = 5) -> None:
    """Raise with a few examples when ``bad`` has rows; only those few return."""
    rows = bad.take(show)
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def split(df: DataFrame, bad: Column, reason: Column | str) -> tuple[DataFrame, DataFrame]:
    """REC-17.  (good rows, quarantined rows with ``reason``); the run goes on."""
    b = F.coalesce(bad, F.lit(False))
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.filter(~b), df.filter(b).withColumn("reason", why)


def require_no_nulls(df: DataFrame, columns) -> DataFrame:
    """FLT-9.  The frame itself, or an error that counts the missing values."""
    n = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    missing = {k: v for k, v in n.items() if v}
    if missing:
        raise ValueError(f"missing values: {missing}")
    return df


def set_aside(df: DataFrame, problems: DataFrame, keys) -> DataFrame:
    """Rows of series that have no problem.  The series with one are few; their table
    meets the rows in a join that adaptive execution broadcasts or splits by its size."""
    return df.join(problems.select(*keys).distinct(), list(keys), "left_anti")
