"""Table schemas shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

AUTH_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Columns every detector emits, in this order.
ANOMALY_COLUMNS = [
    "event_id",
    "timestamp",
    "username",
    "ip_address",
    "event_type",
    "anomaly_type",
    "severity",
    "details",
]

ALERT = T.StructType(
    [
        T.StructField("alert_id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("username", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("notified", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US
