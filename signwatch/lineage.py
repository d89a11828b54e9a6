"""Cutting long lineages of iterative jobs on reliable storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a folder of our own only where none is set and Spark is local."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path next to the checkpoints, for tables and stream state of one run."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`scratch` has named, on whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
