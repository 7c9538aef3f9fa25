"""Cutting lineage through tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_created: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the session names, else a new one for local runs only."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hourgrid-"))
    return context.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Boosting cuts the lineage of its residuals through the context's checkpoint folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/hourgrid-{label}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables this process staged; results that still read them must be finished."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    count = 0
    while _created:
        path = jvm.org.apache.hadoop.fs.Path(_created.pop())
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Used where several consumers need the same reduced table: it is computed once, survives the loss of
    executors, stays columnar, and gives the planner true sizes for its join choices.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
