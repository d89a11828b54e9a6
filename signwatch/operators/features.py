"""Numeric feature tables for the models and the explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import calendar, event_code, hash_bucket, is_private_ip, text
from signwatch.lineage import cut
from signwatch.operators.detectors import known_users, time_since_last
from signwatch.schema import DAY_US
from signwatch.skew import HOT_ROWS, micros, salted_join

# Column order of the model matrices.
ML_COLUMNS = [
    "hour",
    "day_of_week",
    "day_of_month",
    "month",
    "username_encoded",
    "ip_hash",
    "event_type_encoded",
    "hour_username_interaction",
]
SIMPLE_COLUMNS = ["hour", "day_of_week", "minute", "username_encoded", "ip_encoded", "event_encoded"]
CLIENT_COLUMNS = [
    "hour",
    "day_of_week",
    "day_of_month",
    "month",
    "username_hash",
    "ip_hash",
    "is_private_ip",
    "event_type_encoded",
    "hour_username_interaction",
]


def label_codes(df: DataFrame, column: str, null_as: str = "None") -> DataFrame:
    """(label, code): 0-based position of each distinct value in sorted order.

    Values are range-sorted across tasks and numbered per task; the task totals give each task its offset. The
    sorted values are written out first, so the task numbers stay the same however often they are read.
    """
    labels = df.select(text(column, null_as).alias("label")).distinct().orderBy("label")
    labels = cut(labels.withColumn("_part", F.spark_partition_id()))
    sizes = labels.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per task
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy("label"))
    return (
        labels.withColumn("_local", local)
        .join(offsets, "_part")
        .select("label", (F.col("_offset") + F.col("_local") - 1).cast("bigint").alias("code"))
    )


def encode(
    df: DataFrame,
    column: str,
    name: str,
    codes: DataFrame | None = None,
    null_as: str = "None",
    base: DataFrame | None = None,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the label code of ``column``; a value missing from ``codes`` gets the number of known labels.

    ``base`` is the event table behind ``df``, where ``df`` is already a long plan.
    """
    base = df if base is None else base
    codes = label_codes(base, column, null_as) if codes is None else codes
    label = text(column, null_as)
    joined = salted_join(
        df.withColumn("label", label),
        codes,
        ["label"],
        "left",
        spread=["event_id"],
        base=base.select(label.alias("label")),
        max_rows=max_rows,
    )
    unseen = codes.agg(F.count(F.lit(1))).scalar()
    return joined.withColumn(name, F.coalesce("code", unseen)).drop("code", "label")


def ml_features(events: DataFrame, codes: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """event_id, the columns to keep and those of ``ML_COLUMNS``; missing values are 0."""
    parts = calendar()
    rows = encode(events, "username", "username_encoded", codes).withColumns(
        {name: parts[name] for name in ML_COLUMNS if name in parts}
        | {"ip_hash": hash_bucket("ip_address"), "event_type_encoded": event_code()}
    )
    rows = rows.withColumn("hour_username_interaction", F.col("hour") * F.col("username_encoded"))
    return rows.select("event_id", *keep, *ML_COLUMNS).fillna(0, ML_COLUMNS)


def ml_features_simple(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    rows = encode(events, "username", "username_encoded", null_as="unknown")
    rows = encode(rows, "ip_address", "ip_encoded", null_as="0.0.0.0", base=events)
    rows = encode(rows, "event_type", "event_encoded", null_as="unknown", base=events)
    parts = calendar()
    return rows.withColumns({n: parts[n] for n in ("hour", "day_of_week", "minute")}).select(
        "event_id", *keep, *SIMPLE_COLUMNS
    )


def client_features(events: DataFrame, *keep: str) -> DataFrame:
    """The per-client matrix: hashed users and addresses instead of codes."""
    parts = calendar()
    rows = events.withColumns(
        {name: parts[name] for name in CLIENT_COLUMNS if name in parts}
        | {
            "username_hash": hash_bucket("username", "None"),
            "ip_hash": hash_bucket("ip_address", "None"),
            "is_private_ip": is_private_ip(),
            "event_type_encoded": event_code(with_access=False),
        }
    )
    rows = rows.withColumn("hour_username_interaction", F.col("hour") * F.col("username_hash"))
    return rows.select("event_id", *keep, *CLIENT_COLUMNS).fillna(0, CLIENT_COLUMNS)


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus mean over population deviation (1 where the column is constant)."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        )
    ).scalar()
    rows = df.withColumn("_stats", stats)
    spread = {c: F.when(F.col(f"_stats.s_{c}") == 0, 1.0).otherwise(F.col(f"_stats.s_{c}")) for c in columns}
    return rows.withColumns({c: (F.col(c) - F.col(f"_stats.m_{c}")) / spread[c] for c in columns}).drop("_stats")


def explanation_features(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Calendar parts, gap to the previous event, codes, flags and the user's event count and active days."""
    nobody = events.where(F.col("username").isNull()).withColumn("hours_since_last", F.lit(0.0))
    rows = time_since_last(events, max_rows).unionByName(nobody)
    rows = encode(rows, "username", "username_encoded", base=events)
    rows = encode(rows, "ip_address", "ip_encoded", base=events)
    per_user = (
        events.where(F.col("username").isNotNull())
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("login_count"),
            ((F.max(micros("timestamp")) - F.min(micros("timestamp"))) / DAY_US).alias("active_days"),
        )
    )
    rows = salted_join(
        rows, per_user, ["username"], "left", spread=["event_id"], base=known_users(events), max_rows=max_rows
    )
    rows = rows.withColumns(
        calendar() | {"is_private_ip": is_private_ip(), "event_type_encoded": event_code()}
    ).withColumn("hour_username_interaction", F.col("hour") * F.col("username_encoded"))
    return rows.select(
        "event_id",
        "hour",
        "day_of_week",
        "day_of_month",
        "month",
        "minute",
        "hours_since_last",
        "username_encoded",
        "ip_encoded",
        "is_private_ip",
        "event_type_encoded",
        "hour_username_interaction",
        F.coalesce("login_count", F.lit(0)).alias("login_count"),
        F.coalesce("active_days", F.lit(0.0)).alias("active_days"),
    )
