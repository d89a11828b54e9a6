"""Column functions: calendar parts, codes, flags and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event codes of the feature matrices; any other event type is -1.
EVENT_CODES = {"successful_login": 1, "failed_login": 0, "logout": 2, "access": 3}

# Prefixes taken as private addresses.
PRIVATE_PREFIXES = ["10.", "172.", "192.168."]


def hour(ts: str = "timestamp") -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: str = "timestamp") -> Column:
    """Monday = 0."""
    return F.weekday(ts).cast("bigint")


def calendar(ts: str = "timestamp") -> dict[str, Column]:
    return {
        "hour": hour(ts),
        "day_of_week": day_of_week(ts),
        "day_of_month": F.dayofmonth(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "minute": F.minute(ts).cast("bigint"),
    }


def event_code(event_type: str = "event_type", with_access: bool = True) -> Column:
    code = F.lit(-1)
    for name, value in EVENT_CODES.items():
        if with_access or name != "access":
            code = F.when(F.col(event_type) == name, value).otherwise(code)
    return code.cast("bigint")


def hash_bucket(value: str, null_as: str | None = None, buckets: int = 10000) -> Column:
    """Stable bucket number of a string; null gives -1, or the bucket of ``null_as``."""
    text = F.col(value).cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets
    return F.coalesce(bucket, F.lit(-1)).cast("bigint")


def is_private_ip(ip: str = "ip_address", rfc1918: bool = False) -> Column:
    """1 for a private address. ``rfc1918`` narrows 172.* to 172.16.0.0/12."""
    if rfc1918:
        flag = F.col(ip).rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)")
    else:
        flag = F.lit(False)
        for prefix in PRIVATE_PREFIXES:
            flag = flag | F.col(ip).startswith(prefix)
    return F.coalesce(flag, F.lit(False)).cast("bigint")


def score_severity(score: str, high: float = -0.5) -> Column:
    return F.when(F.col(score) < high, "high").otherwise("medium")


def score_severity_three(score: str, high: float = -0.5, medium: float = -0.2) -> Column:
    return F.when(F.col(score) < high, "high").when(F.col(score) < medium, "medium").otherwise("low")


def severity_colour(severity: str = "severity") -> Column:
    return F.when(F.col(severity) == "high", "red").when(F.col(severity) == "medium", "orange").otherwise("green")


def risk_band(risk: str) -> Column:
    return F.when(F.col(risk) > 0.7, "red").when(F.col(risk) > 0.4, "orange").otherwise("green")


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text, rounded on the exact binary value, ties to even."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(fixed(share * 100, digits), F.lit("%"))


def text(value: str | Column, null_as: str = "None") -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.cast("string"), F.lit(null_as))


def elapsed(us: Column) -> Column:
    """Microseconds as ``D days HH:MM:SS[.ffffff]``."""
    second = 1_000_000
    fraction = us % second
    return F.concat(
        F.floor(us / (86400 * second)).cast("string"),
        F.lit(" days "),
        F.lpad(F.floor(us / (3600 * second)) % 24, 2, "0"),
        F.lit(":"),
        F.lpad(F.floor(us / (60 * second)) % 60, 2, "0"),
        F.lit(":"),
        F.lpad(F.floor(us / second) % 60, 2, "0"),
        F.when(fraction > 0, F.concat(F.lit("."), F.lpad(fraction, 6, "0"))).otherwise(""),
    )
