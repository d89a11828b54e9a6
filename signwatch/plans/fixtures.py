"""Event, log-line, biometric, client and alert tables derived from the given ``events`` and ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.lineage import scratch
from signwatch.schema import DAY_US

AS_OF = "2024-01-31 00:00:00"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_k(load(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of files."""
    schema = load(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # a watermark needs a zoned timestamp
    return as_auth_events(files).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


#: How late events come in ``shuffled_stream``, how long it gathers them, and the delay that drops none.
LATE_DAYS, GATHERED_DAYS = 2, 5
LATE_DELAY = f"{LATE_DAYS + GATHERED_DAYS} days"


#: Rows of a file of arrivals; a larger period is several files.
ARRIVAL_ROWS = 250_000


def shuffled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream in order of arrival, each up to two days late; a micro-batch holds five days of arrivals."""
    timed = auth_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATE_DAYS * DAY_US))
    timed = timed.withColumn("arrival", F.floor((F.unix_micros("timestamp") + late) / (GATHERED_DAYS * DAY_US)))
    first, last, rows = timed.agg(F.min("arrival"), F.max("arrival"), F.count("arrival")).first()
    periods = range(first or 0, (last or 0) + 1)
    # all periods have as many files, however many tasks read the table
    files = max(1, -(-rows // (len(periods) * ARRIVAL_ROWS)))
    folder = scratch(spark, "arrivals")
    for i in periods:
        timed.where(F.col("arrival") == i).drop("arrival").repartition(files).write.parquet(f"{folder}/p{i}")
    return spark.readStream.schema(timed.drop("arrival").schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/p*")


def auth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_auth_events(load(spark, sf_dir, "events"))


def as_auth_events(events: DataFrame, *more: str) -> DataFrame:
    return _with_k(events).selectExpr(
        "event_id",
        "ts AS timestamp",
        "'host1' AS hostname",
        "'sshd' AS service",
        """CASE event_type WHEN 'error' THEN 'failed_login' WHEN 'signup' THEN 'logout'
           WHEN 'view' THEN 'access' ELSE 'successful_login' END AS event_type""",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('user_', CAST(user_id AS STRING)) END AS username",
        """CASE WHEN event_id % 89 = 0 THEN NULL
           WHEN k < 10 THEN concat('203.0.113.', CAST(k % 4 AS STRING))
           ELSE concat('10.0.0.', CAST(k % 8 AS STRING)) END AS ip_address""",
        "concat('event ', CAST(event_id AS STRING)) AS message",
        *more,
    )


# One expression per log format; each renders every event.
LINE_FORMATS = {
    "syslog": """concat(date_format(timestamp, 'MMM dd HH:mm:ss'), ' host1 sshd[', CAST(event_id AS STRING), ']: ',
        CASE event_type WHEN 'failed_login' THEN 'Failed password for ' WHEN 'logout' THEN 'Disconnected from user '
          WHEN 'access' THEN 'Received signal for ' ELSE 'Accepted password for ' END,
        coalesce(username, 'invalid user x'), ' from ', coalesce(ip_address, 'nowhere'), ' port 22 ssh2')""",
    "json": """concat('{"timestamp": "', date_format(timestamp, 'yyyy-MM-dd HH:mm:ss'), '", "username": "',
        coalesce(username, ''), '", "ip_address": "', coalesce(ip_address, ''), '", "event_type": "', event_type, '"}')""",
    "csv": """concat(date_format(timestamp, 'yyyy-MM-dd HH:mm:ss'), ',', coalesce(username, ''), ',',
        coalesce(ip_address, ''), ',', event_type, ',', message)""",
    "apache": """concat(coalesce(ip_address, '-'), ' - ', coalesce(username, '-'), ' [',
        date_format(timestamp, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] "GET /login HTTP/1.1" ',
        CASE event_type WHEN 'failed_login' THEN '401' WHEN 'logout' THEN '302' ELSE '200' END, ' 512 "-" "agent"')""",
}


def log_lines(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """(event_id, line): every event rendered in one format."""
    return auth_events(spark, sf_dir).selectExpr("event_id", f"{LINE_FORMATS[fmt]} AS line")


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, line): all events, the format varying from line to line, with unreadable lines between."""
    f = LINE_FORMATS
    return auth_events(spark, sf_dir).selectExpr(
        "event_id",
        f"""CASE event_id % 5 WHEN 0 THEN {f["syslog"]} WHEN 1 THEN {f["json"]} WHEN 2 THEN {f["csv"]}
            WHEN 3 THEN {f["apache"]} ELSE concat('garbage ', CAST(event_id AS STRING)) END AS line""",
    )


SESSION = "concat(CAST(user_id AS STRING), '-', CAST(CAST(floor(day(ts) / 10) AS INT) AS STRING)) AS session_id"


def keystrokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id",
        "concat('user_', CAST(user_id AS STRING)) AS username",
        SESSION,
        "ts AS timestamp",
        "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'down' ELSE 'up' END AS keystroke_type",
        "CAST(k % 4 AS STRING) AS key",
    )


def mouse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id",
        "concat('user_', CAST(user_id AS STRING)) AS username",
        SESSION,
        "ts AS timestamp",
        "CAST(k AS BIGINT) AS x",
        "CAST(floor(value) AS BIGINT) AS y",
        "CASE event_type WHEN 'click' THEN 'click' ELSE 'move' END AS event_type",
    )


def client_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_auth_events(
        load(spark, sf_dir, "events"),
        "concat('client_', CAST(user_id % 3 AS STRING)) AS client_id",
        "CAST(CASE WHEN value > 50 THEN 1 ELSE 0 END AS BIGINT) AS label",
    )


def client_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "embeddings")
        .select("vec_id", F.posexplode("embedding").alias("pos", "v"))
        .selectExpr(
            "vec_id AS client_id",
            "CAST(1 + vec_id % 5 AS BIGINT) AS weight",
            "CAST(pos AS BIGINT) AS idx",
            "CAST(v AS DOUBLE) AS grad",
        )
    )


def alerts_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        auth_events(spark, sf_dir)
        .where("event_type <> 'successful_login'")
        .selectExpr(
            "event_id AS alert_id",
            "timestamp",
            "username",
            "ip_address",
            "CASE event_type WHEN 'failed_login' THEN 'high' WHEN 'logout' THEN 'medium' ELSE 'low' END AS severity",
            """CASE event_id % 3 WHEN 0 THEN 'unusual_time' WHEN 1 THEN 'location_change'
               ELSE 'high_frequency' END AS anomaly_type""",
            """concat('alert raised for ', coalesce(username, 'Unknown'), ' while signing in from address ',
               coalesce(ip_address, 'Unknown')) AS details""",
            "CASE event_id % 10 WHEN 0 THEN 'acknowledged' WHEN 1 THEN 'cleared' ELSE 'active' END AS status",
        )
    )
