"""Incremental processing with Structured Streaming, and windowed extensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.operators.sets import snapshot_diff


def process_new(stream: DataFrame, key: str, tracking: str, checkpoint: str, action: Callable[[DataFrame, int], None], once: bool = True):
    """Runs ``action`` on rows whose key isn't in the tracking table yet, then appends the keys to it.

    Keys are tracked per batch after the action has succeeded, so a batch that fails is tried again and one that is
    replayed finds its keys tracked.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        path = f"{tracking}/batch={batch_id}"
        done = None
        try:
            done = spark.read.option("basePath", tracking).parquet(tracking).where(F.col("batch") != batch_id).select(key).distinct()
        except Exception as e:  # nothing tracked yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh = df.dropDuplicates([key])
        if done is not None:
            fresh = fresh.join(done, key, "left_anti")
        fresh = fresh.persist()
        try:
            action(fresh, batch_id)
            fresh.select(key).write.mode("overwrite").parquet(path)
        finally:
            fresh.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def monitor_snapshot(spark: SparkSession, latest: DataFrame, key: str, path: str) -> DataFrame | None:
    """Compares with the stored snapshot and replaces it if anything changed; None on the first run.

    Snapshots are numbered folders, so one that is being written is never read.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at(path))] if fs.exists(at(path)) else []
    versions = sorted(int(v[1:]) for v in names if v[:1] == "v" and v[1:].isdigit() and fs.exists(at(f"{path}/{v}/_SUCCESS")))
    keys = latest.select(key).distinct()
    if not versions:
        keys.write.parquet(f"{path}/v1")
        return None
    diff = snapshot_diff(keys, spark.read.parquet(f"{path}/v{versions[-1]}"), key).persist()
    if not diff.isEmpty():
        keys.write.mode("overwrite").parquet(f"{path}/v{versions[-1] + 1}")
    return diff


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows and sums per tumbling window and kind; works on a stream (with a watermark) and on a table. An extension."""
    source = events.withWatermark(ts, late) if events.isStreaming else events
    return source.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")
