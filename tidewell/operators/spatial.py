"""JOIN-8.  Points to regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting over a ring ``array<struct<x,y>>`` (closed or not)."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.element_at(ring, i + 1).alias("a"), F.element_at(ring, (i + 1) % n + 1).alias("b")))
    crossed = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (
        x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
    return F.size(crossed) % 2 == 1


def region_cells(regions: DataFrame, cell: float) -> DataFrame:
    """Square cells the bounding box of each region covers."""
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    span = lambda a: F.sequence(F.floor(F.array_min(a) / cell), F.floor(F.array_max(a) / cell))
    return regions.withColumn("__cx", F.explode(span(xs))).withColumn("__cy", F.explode(span(ys)))


def region_join(points: DataFrame, regions: DataFrame, key="station_id", x="x", y="y", cell=1.0, default="default") -> DataFrame:
    """Region of each point, ``default`` outside all; the first name if several hold it.

    Points and regions meet on grid cells, an equality join; the ray is cast only
    for the points in a cell of the region.
    """
    p = points.withColumn("__cx", F.floor(F.col(x) / cell)).withColumn("__cy", F.floor(F.col(y) / cell))
    hits = p.select(key, x, y, "__cx", "__cy").join(region_cells(regions, cell), ["__cx", "__cy"])
    hits = hits.filter(inside(F.col("ring"), F.col(x), F.col(y))).groupBy(key).agg(F.min("region").alias("region"))
    return points.join(hits, key, "left").withColumn("region", F.coalesce("region", F.lit(default)))
