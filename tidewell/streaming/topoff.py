"""STR-1.  Late and corrected rows as a stream into the repository.

The stream uses the batch plan: REC-6 compares a micro-batch with the repository
and names the shards it touches; shards it only adds to or corrects are merged by
time, so any way to cut the input into batches ends in the content that one batch
over all of it gives.  (REC-8 merges by span, which depends on the cuts, so its
content rule is used for new shards only.)

The repository is partitioned by parameter, shard and a bucket of the series, so a
late row rewrites the rows of few series.  Applied batch ids are recorded beside the
data; a batch that comes again after a restart changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidewell.operators.reconcile import overwrite_shards, plan_update
from tidewell.session import stage

PARTITION = ("param", "shard", "bucket")


def _stored(spark, path: str, schema: T.StructType) -> DataFrame:
    """A table with its schema given, so that texts that look like numbers stay texts."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_repository(spark, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a repository that the stream writes; ``schema`` is that of the staged rows."""
    return _stored(spark, f"{path}/data", schema)


def topoff_batch(staged: DataFrame, batch_id: int, path: str, keys, prefer="staged", buckets=16, this_year=9999) -> None:
    """Apply one batch.  A batch that changes nothing writes nothing, and one that
    was recorded as applied is skipped."""
    spark = staged.sparkSession
    done = _stored(spark, f"{path}/applied", T.StructType([T.StructField("batch_id", T.LongType())]))
    if not done.filter(F.col("batch_id") == batch_id).isEmpty():
        return
    sh = [*keys, "shard"]
    cols = [*sh, "ts", "value"]
    new = stage(staged.select(*cols).groupBy(*sh, "ts").agg(F.max("value").alias("value")))
    old = read_repository(spark, path, new.schema).select(*cols).join(new.select(*sh).distinct(), sh, "left_semi")
    # every shard is inspected: a correction of an old year counts like one of this year
    plan = stage(plan_update(new, old, keys, this_year, p3=1.0, p10=1.0, regular=False, escalate=False))
    rank = 0 if prefer == "staged" else 1
    both = new.withColumn("r", F.lit(rank)).unionByName(old.withColumn("r", F.lit(1 - rank))).join(plan.select(*sh), sh, "left_semi")
    at = F.when(F.col("value").isNotNull(), F.col("r"))
    was = F.max(F.when(F.col("r") != rank, F.struct("value")))
    merged = stage(both.groupBy(*sh, "ts").agg(F.min_by("value", at).alias("value"), was.alias("was")))
    changed = merged.filter(F.col("was").isNull() | ~F.col("value").eqNullSafe(F.col("was")["value"]))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
    live = stage(changed.select("param", "shard", bucket).distinct())
    if not live.isEmpty():
        # whole partitions are rewritten: with the rows of the series in them that the batch does not touch
        whole = read_repository(spark, path, new.schema).select(*cols).withColumn("bucket", bucket).join(live, list(PARTITION), "left_semi")
        rest = whole.join(merged.select(*sh).distinct(), sh, "left_anti")
        out = stage(merged.drop("was").withColumn("bucket", bucket).join(live, list(PARTITION), "left_semi").unionByName(rest))
        overwrite_shards(out, f"{path}/data", PARTITION)
    spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("append").parquet(f"{path}/applied")


def stream_topoff(staged_stream: DataFrame, path: str, checkpoint: str, keys, prefer="staged", buckets=16):
    """Start the stream of staged rows (keys, shard, ts, value) into ``path``.  One
    checkpoint folder goes with one repository: batch ids count in it."""
    return (staged_stream.writeStream.foreachBatch(lambda df, i: topoff_batch(df, i, path, keys, prefer, buckets))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
