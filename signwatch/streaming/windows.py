"""Sliding-window metrics and the detectors on them, over tables and over streams.

Windows follow event time. A watermark bounds the state and drops events that come later than the delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signwatch.functions.scalars import fixed, hour
from signwatch.operators import forest
from signwatch.operators.detectors import top_values
from signwatch.schema import MINUTE_US
from signwatch.skew import micros

SIZE, SLIDE = "5 minutes", "1 minute"
VECTOR = ["login_count", "avg_hour", "unique_ips"]


def minutes(interval: str) -> float:
    number, unit = interval.split()
    return float(number) * {"minute": 1, "hour": 60, "day": 1440}[unit.rstrip("s")]


# --- metrics over tables ---------------------------------------------------------------------------------


def cells(events: DataFrame, slide: str = SLIDE) -> DataFrame:
    """Counts per (slide bucket, user, address). Windows are then put together from these instead of raw rows."""
    success, failure = F.col("event_type") == "successful_login", F.col("event_type") == "failed_login"
    return events.groupBy(
        F.window("timestamp", slide).getField("start").alias("bucket"), "username", "ip_address"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(success).alias("ok"),
        F.count_if(failure).alias("failed"),
        F.sum(hour()).alias("hours"),
    )


def _start(size: str, slide: str) -> Column:
    return F.window("bucket", size, slide)


def window_counts(events: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    buckets = events.groupBy(F.window("timestamp", slide).getField("start").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return (
        buckets.groupBy(_start(size, slide).alias("w"))
        .agg(F.sum("n").alias("total_events"))
        .select(F.col("w.start").alias("window_start"), "total_events")
    )


def window_metrics(events: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    return (
        cells(events, slide)
        .groupBy(_start(size, slide).alias("w"))
        .agg(
            F.sum("n").alias("total_events"),
            F.count_distinct("username").alias("unique_users"),
            F.count_distinct("ip_address").alias("unique_ips"),
            F.sum("ok").alias("successful_logins"),
            F.sum("failed").alias("failed_logins"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "total_events",
            "unique_users",
            "unique_ips",
            "successful_logins",
            "failed_logins",
            (F.col("total_events") / minutes(size)).alias("login_rate_per_minute"),
        )
    )


def window_user_metrics(events: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    return (
        cells(events.where(F.col("username").isNotNull()), slide)
        .groupBy(_start(size, slide).alias("w"), "username")
        .agg(
            F.sum("n").alias("login_count"),
            (F.sum("ok") / F.sum("n")).alias("success_rate"),
            F.count_distinct("ip_address").alias("unique_ips"),
            (F.sum("hours") / F.sum("n")).alias("avg_hour"),
        )
        .select(F.col("w.start").alias("window_start"), "username", "login_count", "success_rate", "unique_ips", "avg_hour")
    )


# --- baseline and detectors ------------------------------------------------------------------------------


def baseline(events: DataFrame, first: int = 10, slide_minutes: int = 5, k: int = 3) -> DataFrame:
    """Per-user habits in the first ``first`` events: rate per minute and the most common addresses and hours."""
    sample = events.orderBy("timestamp", "event_id").limit(first).where(F.col("username").isNotNull())
    sample = sample.withColumn("hour", hour())

    def common(value: str, name: str) -> DataFrame:
        ranked = top_values(sample, ["username"], value, k).select("username", F.struct("rank", value).alias("r"))
        # at most k entries per user
        return ranked.groupBy("username").agg(
            F.transform(F.array_sort(F.collect_list("r")), lambda r: r[value].cast("string")).alias(name)
        )

    counts = sample.groupBy("username").agg((F.count(F.lit(1)) / (first * slide_minutes)).alias("avg_login_frequency"))
    return (
        counts.join(common("ip_address", "common_ips"), "username", "left")
        .join(common("hour", "preferred_times"), "username", "left")
        .withColumn("common_ips", F.coalesce("common_ips", F.array().cast("array<string>")))
    )


def average_rate(events: DataFrame) -> DataFrame:
    """One row: events per minute over the whole span."""
    us = micros("timestamp")
    return events.agg((F.count(F.lit(1)) / ((F.max(us) - F.min(us)) / MINUTE_US)).alias("rate"))


def volume_spikes(metrics: DataFrame, historical: Column | float = 1.0, factor: float = 3.0) -> DataFrame:
    """Windows whose rate is above ``factor`` times the historical rate."""
    base = F.lit(historical) if isinstance(historical, (int, float)) else historical
    rows = metrics.withColumn("baseline_value", base).where(F.col("login_rate_per_minute") > F.col("baseline_value") * factor)
    return rows.select(
        "window_start",
        F.lit("volume_spike").alias("anomaly_type"),
        F.lit("high").alias("severity"),
        F.col("login_rate_per_minute").alias("metric_value"),
        "baseline_value",
        F.concat(
            F.lit("Login rate spike: "),
            fixed(F.col("login_rate_per_minute"), 2),
            F.lit(" vs baseline "),
            fixed(F.col("baseline_value"), 2),
            F.lit(" per minute"),
        ).alias("details"),
    )


def unusual_ips(user_metrics: DataFrame, habits: DataFrame, factor: int = 2) -> DataFrame:
    """User windows with more addresses than ``factor`` times the user's common ones; all compared rows, flagged."""
    known = habits.select("username", F.size("common_ips").alias("_known"))
    rows = user_metrics.join(known, "username")
    return rows.select(
        "window_start",
        "username",
        "unique_ips",
        (F.col("unique_ips") > F.col("_known") * factor).alias("is_unusual"),
        F.concat(
            F.lit("User "),
            F.col("username"),
            F.lit(" logging in from "),
            F.col("unique_ips").cast("string"),
            F.lit(" IPs vs baseline of "),
            F.col("_known").cast("string"),
        ).alias("details"),
    )


def behaviour_vectors(user_metrics: DataFrame) -> DataFrame:
    return user_metrics.select(
        F.xxhash64("window_start", "username").alias("event_id"), "window_start", "username", *VECTOR
    )


def fit_behaviour(user_metrics: DataFrame, contamination: float = 0.1) -> forest.Forest | None:
    return forest.fit(behaviour_vectors(user_metrics), VECTOR, contamination)


def unusual_behaviour(user_metrics: DataFrame, model: forest.Forest) -> DataFrame:
    """User windows the forest takes for anomalous."""
    scored = forest.score(behaviour_vectors(user_metrics), model)
    return scored.where(F.col("anomaly_score") < 0).select(
        "window_start",
        "username",
        F.lit("behavioral_pattern").alias("anomaly_type"),
        F.lit("medium").alias("severity"),
        "anomaly_score",
        F.concat(F.lit("ML-detected anomaly for user "), F.col("username")).alias("details"),
    )


# --- streams ---------------------------------------------------------------------------------------------


def stream_metrics(stream: DataFrame, delay: str = "1 minute", size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Window metrics of a stream, as ``window_metrics`` has them over tables, once the watermark has passed a window's end.

    Two stateful steps: first one row per window and different user or address with its counts, then their number and sums.
    An event counts under its user and under its address; the users' rows carry the totals.
    """
    success, failure = F.col("event_type") == "successful_login", F.col("event_type") == "failed_login"
    marks = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in ("username", "ip_address")))
    per = (
        stream.withWatermark("timestamp", delay)
        .select("timestamp", "event_type", F.explode(marks).alias("mark"))
        .groupBy(F.window("timestamp", size, slide).alias("w"), "mark.kind", "mark.value")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(success).alias("ok"), F.count_if(failure).alias("failed"))
    )
    user, ip = F.col("kind") == "username", F.col("kind") == "ip_address"
    total = lambda name: F.sum(F.when(user, F.col(name)).otherwise(0))
    return (
        per.groupBy("w")
        .agg(
            total("n").alias("total_events"),
            F.count(F.when(user, F.col("value"))).alias("unique_users"),
            F.count(F.when(ip, F.col("value"))).alias("unique_ips"),
            total("ok").alias("successful_logins"),
            total("failed").alias("failed_logins"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "total_events",
            "unique_users",
            "unique_ips",
            "successful_logins",
            "failed_logins",
            (F.col("total_events") / minutes(size)).alias("login_rate_per_minute"),
        )
    )


def stream_user_metrics(stream: DataFrame, delay: str = "1 minute", size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Metrics per window and user of a stream, as ``window_user_metrics`` has them over tables.

    First one row per window, user and address, so a user with many events or addresses is spread over many states.
    """
    per = (
        stream.where(F.col("username").isNotNull())
        .withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", size, slide).alias("w"), "username", "ip_address")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "successful_login").alias("ok"),
            F.sum(hour()).alias("hours"),
        )
    )
    return (
        per.groupBy("w", "username")
        .agg(
            F.sum("n").alias("login_count"),
            (F.sum("ok") / F.sum("n")).alias("success_rate"),
            F.count("ip_address").alias("unique_ips"),
            (F.sum("hours") / F.sum("n")).alias("avg_hour"),
        )
        .select(F.col("w.start").alias("window_start"), "username", "login_count", "success_rate", "unique_ips", "avg_hour")
    )


def start(df: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "1 minute") -> StreamingQuery:
    """Append a stream's results to Parquet files, exactly once."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start(path)


def start_detection(
    stream: DataFrame,
    habits: DataFrame,
    path: str,
    checkpoint: str,
    historical_rate: float = 1.0,
    model: forest.Forest | None = None,
    delay: str = "1 minute",
    size: str = SIZE,
    slide: str = SLIDE,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Watch a live stream: one query on window totals, one on user windows, each appending its anomalies."""
    spikes = volume_spikes(stream_metrics(stream, delay, size, slide), historical_rate)

    def user_batch(batch: DataFrame, batch_id: int) -> None:
        # the folder is named after the batch, so that a repeated batch replaces its own output
        flagged = unusual_ips(batch, habits).where("is_unusual")
        flagged.write.mode("overwrite").parquet(f"{path}/unusual_ip/batch={batch_id}")
        if model is not None:
            unusual_behaviour(batch, model).write.mode("overwrite").parquet(f"{path}/behaviour/batch={batch_id}")

    users = stream_user_metrics(stream, delay, size, slide).writeStream.foreachBatch(user_batch)
    users = users.option("checkpointLocation", f"{checkpoint}/users")
    users = users.trigger(availableNow=True) if available_now else users.trigger(processingTime="1 minute")
    return [start(spikes, f"{path}/volume", f"{checkpoint}/volume", available_now), users.start()]
