"""Session helpers: configuration, tables and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("archivolt")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")  # one process holds the executors, too; 1 GB is short for a whole test run
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``, else the checkpoint directory that was set.

    Where there is neither, a temporary folder is set on one machine (tests); on a cluster that is an error, as executors
    would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="archivolt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        named = "file://" + path
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read back: cuts the lineage and, unlike ``cut``, tells Spark the size,
    so that joins with it are broadcast where it is small and shuffled where it isn't.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in a folder of this application that is deleted when it ends."""
    context = spark.sparkContext
    root = os.path.join(shared_dir(spark), f"scratch-{context.applicationId}")
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")
