"""Session settings the operators rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a union of placed branches is not zipped by partition: adaptive execution may
    # coalesce them to different numbers of partitions
    "spark.sql.unionOutputPartitioning": "false",
    # rows that Python holds at once: texts are long, and two workers share an executor
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("tidewell")
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    return (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results depend on, for a session made elsewhere.  Clock
    arithmetic runs on naive timestamps, so the session clock is UTC."""
    for k in ("spark.sql.session.timeZone", "spark.sql.unionOutputPartitioning", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set(k, SETTINGS[k])
    ship(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, where they would not
    find it: neither on PYTHONPATH nor in the folder a local session works in."""
    root, sc = Path(__file__).resolve().parents[1], spark.sparkContext
    found = str(root) in map(os.path.realpath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))
    if found or (sc.master.startswith(("local[", "local ")) and Path.cwd() == root) or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/tidewell", "zip", root, "tidewell"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the one the cluster names, else a scratch one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder, for files written by Spark."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df):
    """Write a costly intermediate once, so that later branches read it back.

    The files live in the shared folder, so a lost executor does not lose them.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)
