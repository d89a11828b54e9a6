"""Sinks and stores: parsed logs as CSV, profiles and alerts as Parquet, alert lines as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.schema import ALERT, AUTH_EVENT


def write_events_csv(events: DataFrame, path: str) -> None:
    """One folder of CSV parts, globally ordered by time across the parts."""
    events.select(*AUTH_EVENT.fieldNames()).orderBy("timestamp").write.mode("overwrite").option(
        "header", True
    ).csv(path, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUTH_EVENT).option("header", True).csv(path, timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]")


def write_snapshot(table: DataFrame, path: str, snapshot: str) -> None:
    """Keep a dated copy of a profile table."""
    table.write.mode("overwrite").parquet(f"{path}/snapshot={snapshot}")


def read_snapshot(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    return spark.read.parquet(f"{path}/snapshot={snapshot}")


def write_alerts(alerts: DataFrame, path: str) -> None:
    """The alert history of a run, one folder per day; a rerun replaces it."""
    alerts.select(*ALERT.fieldNames()).withColumn("day", F.to_date("timestamp")).write.mode("overwrite").partitionBy(
        "day"
    ).parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_alert_log(lines: DataFrame, path: str, column: str = "line") -> None:
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
