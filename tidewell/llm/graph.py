"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.session import stage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every id in a link: the smallest id it can reach.

    Each round hangs every node's larger neighbours, then its smaller ones, on its
    smallest neighbour; the number of rounds grows with the logarithm of the
    longest path.  The minimum is an aggregate with a partial step, and goes back
    to the links by a join that adaptive execution can split, so a node with very
    many links is never gathered.  Null ends and self-links are left out; an empty
    table gives an empty one.
    """
    edges = stage(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    before = _digest(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        hung = both.filter("v > u").join(large, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = _down(hung)
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        near = down.join(small, "u")
        edges = stage(_down(near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))))
        after = _digest(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops)


def _down(e: DataFrame) -> DataFrame:
    return e.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
