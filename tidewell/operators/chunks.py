"""Ordered scans over series of any length.

``Window.partitionBy(series)`` puts a whole series into one task.  One series
may hold a third of all rows, so nothing here does that.  A series is cut into
chunks of time, and an ordered question is answered in two levels:

1. inside a chunk, by a window over ``(series, chunk)``;
2. across chunks, by a window over one small summary row per chunk.

The summary joins back on ``(series, chunk)``, the partitioning the rows
already have, so an operator moves its rows once.  Rows of a chunk are bounded
by chunk width over sampling step, because ``(series, ts)`` is unique;
``plan_chunk`` measures the width to use.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.schema import MICROS, col, micros

CHUNK = "__chunk"
DEFAULT_SECONDS = 30 * 86400
TARGET_ROWS = 1_000_000
_UP = Window.unboundedPreceding


def plan_chunk(df: DataFrame, ts: str = "ts", target_rows: int = TARGET_ROWS) -> int:
    """Chunk width in seconds such that the busiest chunk stays near the target.

    One column scan and one small aggregate; only a single number returns.
    """
    busiest = (
        df.groupBy(F.date_trunc("hour", col(ts)).alias("h")).count().agg(F.max("count")).first()[0]
    )
    if not busiest:
        return DEFAULT_SECONDS
    return int(min(DEFAULT_SECONDS, max(1, 3600 * target_rows // busiest)))


def chunked(
    df: DataFrame, keys: Sequence[str], seconds: int = DEFAULT_SECONDS, ts: str = "ts", by: Column | None = None
) -> DataFrame:
    """Place rows by (series, chunk).  Does nothing if they already are.

    Keys and times are never NULL in this data model.  Saying so here keeps the
    two branches of a scan alike (the join on these columns would add the same
    filter to one of them only), so they share one exchange.
    """
    if CHUNK in df.columns:
        return df
    part = by if by is not None else F.floor(micros(ts) / F.lit(seconds * MICROS).cast("long")).cast("long")
    d = df.withColumn(CHUNK, part)
    for c in (*keys, CHUNK):
        d = d.filter(F.col(c).isNotNull())
    return d.repartition(*keys, CHUNK)


def summarize(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``df.groupBy(by).agg(aggs)`` for a frame that a second branch of the plan
    reads as well.

    The filter (always true) makes the aggregate read every column of ``df``.
    Without it column pruning would give the two branches different inputs, and
    Spark could not reuse one exchange for both: whatever is below would run
    once per branch, and a chain of operators would double it at every step.
    """
    rows = F.greatest(F.count(F.lit(1)), *[F.count(F.col(c)) for c in df.columns])
    return df.groupBy(*by).agg(*aggs, rows.alias("__rows")).filter("__rows >= 0").drop("__rows")


class Spec(NamedTuple):
    kind: str
    expr: Column
    when: Column | None = None
    inclusive: bool = False
    pos: bool = False


def prev(expr, when=None, inclusive=False, pos=False) -> Spec:
    """Value of ``expr`` at the closest earlier row where ``when`` holds."""
    return Spec("prev", col(expr), when, inclusive, pos)


def following(expr, when=None, inclusive=False, pos=False) -> Spec:
    """Value of ``expr`` at the closest later row where ``when`` holds."""
    return Spec("next", col(expr), when, inclusive, pos)


def running(expr) -> Spec:
    """Running sum up to and including the row."""
    return Spec("sum", col(expr))


def position() -> Spec:
    """Row number inside the series, from 1."""
    return Spec("pos", F.lit(1))


def overall(how: str, expr) -> Spec:
    """``min``, ``max`` or ``sum`` of the whole series on every row."""
    return Spec(f"all_{how}", col(expr))


_AGG = {"min": F.min, "max": F.max, "sum": F.sum}


def scan(
    df: DataFrame,
    keys: Sequence[str],
    specs: dict[str, Spec],
    order: Sequence[str] = ("ts",),
    seconds: int = DEFAULT_SECONDS,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add one column per spec.  ``pos=True`` also adds ``<name>_pos``."""
    need_pos = any(s.pos or s.kind == "pos" for s in specs.values())
    need_off = need_pos
    base = chunked(df, keys, seconds, order[0])
    fwd = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    bwd = Window.partitionBy(*keys, CHUNK).orderBy(*[F.desc(o) for o in order])
    if need_pos:
        base = base.withColumn("__rn", F.row_number().over(fwd).cast("long"))
    rn = F.col("__rn") if need_pos else F.lit(0).cast("long")
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    # level 2: one row per chunk
    aggs = [F.count(F.lit(1)).alias("__n")]
    for name, s in specs.items():
        if s.kind in ("prev", "next"):
            cond = s.when if s.when is not None else F.lit(True)
            pick = F.max_by if s.kind == "prev" else F.min_by
            aggs.append(pick(s.expr, F.when(cond, at)).alias(f"{name}__v"))
            aggs.append(pick(rn, F.when(cond, at)).alias(f"{name}__p"))
        elif s.kind == "sum":
            aggs.append(F.sum(s.expr).alias(f"{name}__v"))
        elif s.kind.startswith("all_"):
            aggs.append(_AGG[s.kind[4:]](s.expr).alias(f"{name}__v"))
    summary = summarize(base, [*keys, CHUNK], aggs)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(_UP, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(_UP, -1)
    whole = Window.partitionBy(*keys)
    if need_off:
        summary = summary.withColumn("__off", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    off = F.col("__off") if need_off else F.lit(0).cast("long")
    carried = [*keys, CHUNK] + (["__off"] if need_off else [])
    for name, s in specs.items():
        v, p = F.col(f"{name}__v"), F.col(f"{name}__p")
        if s.kind in ("prev", "next"):
            held = F.when(p.isNotNull(), F.struct(v.alias("v"), (p + off).alias("p")))
            over = earlier if s.kind == "prev" else later
            carried.append(F.last(held, True).over(over).alias(f"{name}__c"))
        elif s.kind == "sum":
            carried.append(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{name}__c"))
        elif s.kind.startswith("all_"):
            carried.append(_AGG[s.kind[4:]](v).over(whole).alias(f"{name}__c"))
    carries = summary.select(*carried)

    # level 1: rows of one chunk, completed by what the other chunks carry
    rows = base.join(carries, [*keys, CHUNK])
    taken = {n + x for n in specs for x in ("", "_pos")}
    keep = [c for c in df.columns if c != CHUNK and c not in taken] + ([CHUNK] if keep_chunk else [])
    outs: list[Column | str] = list(keep)
    late: list[Column | str] = list(keep)
    for name, s in specs.items():
        c = F.col(f"{name}__c")
        if s.kind in ("prev", "next"):
            cond = s.when if s.when is not None else F.lit(True)
            side = fwd if s.kind == "prev" else bwd
            frame = side.rowsBetween(_UP, 0 if s.inclusive else -1)
            here = F.last(F.when(cond, F.struct(s.expr.alias("v"), (rn + off).alias("p"))), True).over(frame)
            outs.append(F.coalesce(here, c).alias(name))
            late.append(F.col(name)["v"].alias(name))
            if s.pos:
                late.append(F.col(name)["p"].alias(f"{name}_pos"))
        elif s.kind == "sum":
            here = F.coalesce(F.sum(s.expr).over(fwd.rowsBetween(_UP, 0)), F.lit(0))
            outs.append((here + c).alias(name))
            late.append(name)
        elif s.kind == "pos":
            outs.append((rn + off).alias(name))
            late.append(name)
        else:
            outs.append(c.alias(name))
            late.append(name)
    return rows.select(*outs).select(*late)


def attach(
    df: DataFrame, facts: DataFrame, keys: Sequence[str], seconds: int = DEFAULT_SECONDS, ts: str = "ts",
    keep_chunk: bool = False,
) -> DataFrame:
    """Put one-row-per-series facts on every row (left join).

    The facts are first spread over the chunks of their series, so a hot series
    meets them in many tasks and the rows are not moved to a series-wide one.
    """
    base = chunked(df, keys, seconds, ts)
    spread = summarize(base, [*keys, CHUNK], []).join(facts, list(keys))
    out = base.join(spread, [*keys, CHUNK], "left")
    return out if keep_chunk else out.drop(CHUNK)


def halo_blocks(df: DataFrame, keys: Sequence[str], idx: str, before: int, after: int, block: int) -> DataFrame:
    """Cut a series into blocks of ``block`` positions and copy the rows that a
    frame of ``before`` / ``after`` positions needs from the next blocks.

    Adds ``__block`` and ``__own`` (the row belongs to the block, not its halo).
    """
    i = F.col(idx)
    lo = F.floor((i - F.lit(after)) / F.lit(block))
    hi = F.floor((i + F.lit(before)) / F.lit(block))
    return df.withColumn("__block", F.explode(F.sequence(lo, hi))).withColumn(
        "__own", F.col("__block") == F.floor(i / F.lit(block))
    )


def framed(
    df: DataFrame, keys: Sequence[str], idx: str, before: int, after: int, columns: dict, block: int = 100_000
) -> DataFrame:
    """Columns over frames inside ``[idx - before, idx + after]``.

    Each entry of ``columns`` maps the ordered window of a block to a Column and
    sets its own ``rangeBetween`` on ``idx``.
    """
    block = max(block, before + after + 1)
    rows = halo_blocks(df, keys, idx, before, after, block)
    w = Window.partitionBy(*keys, "__block").orderBy(idx)
    out = rows.select("*", *[f(w).alias(n) for n, f in columns.items()])
    return out.filter("__own").drop("__block", "__own")
