"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.session import scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several branches read, and read it back: it outlives lost
    executors, is smaller than a checkpoint and cuts the lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
