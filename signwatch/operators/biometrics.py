"""Keystroke and mouse dynamics per (username, session_id): samples, user profiles and session scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signwatch.functions.scalars import fixed
from signwatch.operators.asof import next_target
from signwatch.skew import HOT_ROWS, Timeline, micros

SESSION = ["username", "session_id"]
TIE = ["event_id"]
SECOND = 1_000_000


# --- samples ---------------------------------------------------------------------------------------------


def hold_times(keys: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, session_id, hold): key down to the next release of the same key, in seconds."""
    rows = keys.select("event_id", *SESSION, "key", "timestamp", "keystroke_type")
    paired = next_target(rows, [*SESSION, "key"], F.col("keystroke_type") == "up", max_rows=max_rows)
    return paired.where((F.col("keystroke_type") == "down") & F.col("_next_us").isNotNull()).select(
        "event_id", *SESSION, ((F.col("_next_us") - F.col("_us")) / SECOND).alias("hold")
    )


def flight_latency(keys: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, session_id, metric, seconds): up-to-down gaps are flight, down-to-down latency."""
    rows = keys.select("event_id", *SESSION, "timestamp", "keystroke_type")
    line = Timeline(rows, SESSION, TIE, ahead=1, max_rows=max_rows)
    w = line.window()
    paired = line.rows.withColumns(
        {
            "_next": F.lead("keystroke_type").over(w),
            "seconds": (F.lead("_us").over(w) - F.col("_us")) / SECOND,
        }
    )
    metric = F.when(F.col("keystroke_type") == "up", "flight").when(F.col("keystroke_type") == "down", "latency")
    return (
        line.finish(paired)
        .where((F.col("_next") == "down") & metric.isNotNull())
        .select("event_id", *SESSION, metric.alias("metric"), "seconds")
    )


def typing_speed(keys: DataFrame) -> DataFrame:
    """(username, session_id, speed): key events per minute."""
    us = micros("timestamp")
    return (
        keys.groupBy(*SESSION)
        .agg(F.count(F.lit(1)).alias("_n"), ((F.max(us) - F.min(us)) / SECOND / 60).alias("_minutes"))
        .where(F.col("_minutes") > 0)
        .select(*SESSION, (F.col("_n") / F.col("_minutes")).alias("speed"))
    )


def keystroke_samples(keys: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Long form (username, session_id, metric, value)."""
    return (
        hold_times(keys, max_rows)
        .select(*SESSION, F.lit("hold").alias("metric"), F.col("hold").alias("value"))
        .unionByName(flight_latency(keys, max_rows).select(*SESSION, "metric", F.col("seconds").alias("value")))
        .unionByName(typing_speed(keys).select(*SESSION, F.lit("speed").alias("metric"), F.col("speed").alias("value")))
    )


def mouse_moves(mouse: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Per move: step length, speed, acceleration, and the turn angle where it exceeds 45 degrees."""
    moves = mouse.where(F.col("event_type") == "move").select("event_id", *SESSION, "timestamp", "x", "y")
    line = Timeline(moves, SESSION, TIE, back=2, ahead=1, max_rows=max_rows)
    w = line.window()

    def step(name: str, a: int, b: int) -> Column:
        """The change of a column from the row at offset ``a`` to the row at offset ``b``."""
        return F.lag(name, -b).over(w) - F.lag(name, -a).over(w)

    rows = line.rows.withColumns(
        {
            "_dx": step("x", -1, 0),
            "_dy": step("y", -1, 0),
            "_dt": step("_us", -1, 0) / SECOND,
            "_px": step("x", -2, -1),
            "_py": step("y", -2, -1),
            "_pdt": step("_us", -2, -1) / SECOND,
            "_nx": step("x", 0, 1),
            "_ny": step("y", 0, 1),
        }
    )

    def length(x: str, y: str) -> Column:
        return F.sqrt((F.col(x) * F.col(x) + F.col(y) * F.col(y)).cast("double"))

    speed = F.when(F.col("_dt") > 0, length("_dx", "_dy") / F.col("_dt"))
    previous = F.when(F.col("_pdt") > 0, length("_px", "_py") / F.col("_pdt"))
    norms = length("_dx", "_dy") * length("_nx", "_ny")
    cosine = (F.col("_dx") * F.col("_nx") + F.col("_dy") * F.col("_ny")) / F.nullif(norms, F.lit(0.0))
    rows = rows.withColumns({"step": length("_dx", "_dy"), "speed": speed, "us": F.col("_us")})
    rows = line.finish(rows).withColumns(
        {
            "acceleration": (F.col("speed") - previous) / F.col("_dt"),
            "_angle": F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))),
        }
    )
    # acos of a missing cosine would clamp to a number, so guard on it
    angle = F.when(cosine.isNotNull() & (F.col("_angle") > F.acos(F.lit(-1.0)) / 4), F.col("_angle"))
    return rows.select("event_id", *SESSION, "us", "x", "y", "step", "speed", "acceleration", angle.alias("turn"))


def click_intervals(mouse: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, session_id, interval): seconds since the previous click."""
    clicks = mouse.where(F.col("event_type") == "click").select("event_id", *SESSION, "timestamp")
    line = Timeline(clicks, SESSION, TIE, back=1, max_rows=max_rows)
    gap = (F.col("_us") - F.lag("_us").over(line.window())) / SECOND
    rows = line.finish(line.rows.withColumn("interval", gap))
    return rows.where(F.col("interval").isNotNull()).select("event_id", *SESSION, "interval")


def path_efficiency(moves: DataFrame) -> DataFrame:
    """(username, session_id, efficiency): straight line over travelled path, from the rows of ``mouse_moves``."""
    at = F.struct("us", "event_id")
    ends = moves.groupBy(*SESSION).agg(
        F.min(F.struct(at.alias("at"), "x", "y")).alias("_a"),
        F.max(F.struct(at.alias("at"), "x", "y")).alias("_b"),
        F.sum("step").alias("_path"),
    )
    dx, dy = F.col("_b.x") - F.col("_a.x"), F.col("_b.y") - F.col("_a.y")
    straight = F.sqrt((dx * dx + dy * dy).cast("double"))
    return ends.where(F.col("_path") > 0).select(*SESSION, (straight / F.col("_path")).alias("efficiency"))


def mouse_samples(mouse: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    moves = mouse_moves(mouse, max_rows)
    long = moves.select(
        *SESSION, F.expr("stack(3, 'speed', speed, 'acceleration', acceleration, 'turn', turn) AS (metric, value)")
    ).where(F.col("value").isNotNull())
    clicks = click_intervals(mouse, max_rows).select(*SESSION, F.lit("click").alias("metric"), F.col("interval").alias("value"))
    paths = path_efficiency(moves).select(*SESSION, F.lit("efficiency").alias("metric"), F.col("efficiency").alias("value"))
    return long.unionByName(clicks).unionByName(paths)


# --- profiles --------------------------------------------------------------------------------------------

KEY_METRICS = ["hold", "flight", "latency", "speed"]
MOUSE_METRICS = ["speed", "acceleration", "turn", "click", "efficiency"]
WITHOUT_STD = {"turn", "efficiency"}


def _profile(samples: DataFrame, metrics: list[str], counted: list[str]) -> DataFrame:
    aggregates = []
    for m in metrics:
        value = F.when(F.col("metric") == m, F.col("value"))
        aggregates.append(F.coalesce(F.avg(value), F.lit(0.0)).alias(f"{m}_mean"))
        if m not in WITHOUT_STD:
            aggregates.append(F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias(f"{m}_std"))
    aggregates.append(F.count_if(F.col("metric").isin(counted)).alias("samples"))
    return samples.groupBy("username").agg(*aggregates)


def keystroke_profile(samples: DataFrame) -> DataFrame:
    """Mean (0 if none) and sample deviation (0 below two) of the four metrics per user."""
    return _profile(samples, KEY_METRICS, ["hold", "flight", "latency"])


def mouse_profile(samples: DataFrame) -> DataFrame:
    return _profile(samples, MOUSE_METRICS, ["speed", "click"])


# --- scores ----------------------------------------------------------------------------------------------


def _session_means(samples: DataFrame, metrics: list[str]) -> DataFrame:
    return samples.groupBy(*SESSION).agg(
        *[F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(f"now_{m}") for m in metrics]
    )


def _deviation(metric: str) -> Column:
    std = F.col(f"{metric}_std")
    return F.when(std > 0, F.abs(F.col(f"now_{metric}") - F.col(f"{metric}_mean")) / std)


def _score(
    sessions: DataFrame, profile: DataFrame, checks: list, normal: str, missing: str, missing_confidence: float
) -> DataFrame:
    """``checks`` holds (measure, limit, weight, text); a measure above its limit adds measure * weight.

    Both sides are aggregates, one row per session and one per user, and nothing but a projection follows, so a user
    with very many sessions is left to the adaptive skew join.
    """
    rows = sessions.join(profile.withColumn("_known", F.lit(True)), "username", "left")
    rows = rows.withColumns({f"_m{i}": check[0] for i, check in enumerate(checks)})
    score, notes = F.lit(0.0), []
    for i, (_, limit, weight, label) in enumerate(checks):
        measure = F.col(f"_m{i}")
        score = score + F.when(measure > limit, measure * weight).otherwise(0.0)
        notes.append(F.when(measure > limit, F.concat(F.lit(label), fixed(measure, 2))))
    details = F.concat_ws("; ", *notes)
    known = F.coalesce(F.col("_known"), F.lit(False))
    rows = rows.withColumn("anomaly_score", F.when(known, score))
    return rows.select(
        *SESSION,
        F.when(known, F.col("anomaly_score") > 1.0).otherwise(True).alias("is_anomaly"),
        F.when(known, F.least("anomaly_score", F.lit(1.0))).otherwise(missing_confidence).alias("confidence"),
        "anomaly_score",
        F.when(known, F.when(details == "", normal).otherwise(details)).otherwise(missing).alias("details"),
    )


def keystroke_anomaly(samples: DataFrame, profile: DataFrame) -> DataFrame:
    checks = [
        (_deviation("hold"), 2, 0.3, "Hold time deviation: z-score "),
        (_deviation("flight"), 2, 0.3, "Flight time deviation: z-score "),
        (_deviation("speed"), 2, 0.4, "Typing speed deviation: z-score "),
    ]
    sessions = _session_means(samples, KEY_METRICS)
    return _score(sessions, profile, checks, "Normal keystroke pattern", "No keystroke profile for user", 0.9)


def mouse_anomaly(samples: DataFrame, profile: DataFrame) -> DataFrame:
    target = F.col("efficiency_mean")
    change = F.when(target > 0, F.abs(F.col("now_efficiency") - target) / target)
    checks = [
        (_deviation("speed"), 2, 0.4, "Mouse speed deviation: z-score "),
        (_deviation("click"), 2, 0.3, "Click interval deviation: z-score "),
        (change, 0.5, 0.3, "Path efficiency deviation: ratio "),
    ]
    sessions = _session_means(samples, MOUSE_METRICS)
    return _score(sessions, profile, checks, "Normal mouse pattern", "No mouse profile for user", 0.8)


def session_verdict(keystroke: DataFrame, mouse: DataFrame) -> DataFrame:
    """One row per session: anomalous if either part is; confidence is the highest of the anomalous parts."""

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *SESSION,
            F.col("is_anomaly").alias(f"{name}_anomaly"),
            F.col("confidence").alias(f"{name}_confidence"),
            F.concat(F.lit(f"{name.capitalize()}: "), F.col("details")).alias(f"{name}_details"),
        )

    both = part(keystroke, "keystroke").join(part(mouse, "mouse"), SESSION, "full")

    def confidence(name: str) -> Column:
        return F.when(F.col(f"{name}_anomaly"), F.col(f"{name}_confidence")).otherwise(0.0)

    flag = F.coalesce("keystroke_anomaly", F.lit(False)) | F.coalesce("mouse_anomaly", F.lit(False))
    return both.select(
        *SESSION,
        flag.alias("overall_anomaly"),
        F.greatest(confidence("keystroke"), confidence("mouse")).alias("confidence"),
        F.concat_ws("; ", "keystroke_details", "mouse_details").alias("details"),
    )
