"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.lineage import scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet next to the checkpoints, and read again."""
    at = scratch(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


#: Groups with more than one row in so many are broadcast; there are fewer of them than this.
SHARE = 10_000


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, n: int) -> DataFrame:
    """Each of the ``n`` rows with its group's columns, by ``key``; ``size`` says how many of the rows a group has.

    Groups that hold many rows reach them by a broadcast of a bounded table, so no task gets all rows of a group.
    """
    large = F.broadcast(groups.filter(F.col(size) * SHARE > n))
    others = rows.join(large.select(key), key, "left_anti")
    return rows.join(large.drop(size), key).unionByName(others.join(groups.drop(size), key))


def remove(path: str, df: DataFrame) -> None:
    """Delete a table that nothing will read again."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tidy(spark: SparkSession) -> None:
    """Let go of what finished queries leave behind.

    Spark removes shuffle files, broadcasts and generated classes when the driver collects its garbage. Jobs of many
    small queries would fill disks and the driver's memory before it does so by itself.
    """
    gc.collect()
    spark._jvm.System.gc()


class Steps:
    """Named tables of an iterative job in one shared folder. A newer table takes the place of the older one of its name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = scratch(spark, name)
        self.at: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again; the table that had this name must not be needed any more."""
        at = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(at)
        out = self.spark.read.parquet(at)
        if name in self.at:
            remove(self.at[name], out)
        self.at[name] = at
        return out

    def forget(self, *names: str) -> None:
        for name in names:
            if name in self.at:
                remove(self.at.pop(name), self.spark.range(0))
