"""Reading raw log text into the event table.

Each format is a set of column expressions over one line; nothing leaves the JVM. A parser gives a struct
``(ok, timestamp, hostname, service, event_type, username, ip_address, message)``; lines no parser accepts
go to the quarantine table rather than stopping the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.schema import AUTH_EVENT

# Line patterns. (?U) gives \w, \d and \s their Unicode meaning.
SYSLOG = r"(?U)^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+)\[\d+\]:\s+(.*)"
IP = r"(?U)\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
USERNAME = r"(?U)(?:for|user)\s+(\w+)"
# the account after "invalid user" / "user", for the strict reading
STRICT_USERNAME = r"(?U)(?:for invalid user|for user|for|user)\s+(\w+)"
APACHE = r'^(\S+) \S+ (\S+) \[(.+?)\] ".+?" (\d{3}) \S+ ".*?" ".*?".*'
APACHE_SHORT = r'^(\S+) \S+ (\S+) \[(.+?)\] ".+?" (\d{3}) \S+.*'

# order of detection; the two access formats share one pattern
FORMATS = ["syslog", "json", "csv", "apache_common"]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FIELDS = AUTH_EVENT.fieldNames()
BLANKS = " \t\r\n\x0b\x0c"


def _entry(ok: Column, **fields: Column) -> Column:
    columns = []
    for field in AUTH_EVENT.fields:
        value = fields.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return F.when(ok, F.struct(*columns))


def _groups(line: Column, pattern: str, n: int) -> Column:
    """The pattern's groups as an array from one regex pass; null where the line does not match.

    The separator can't be in the line: there it becomes the replacement character. So it shows that the pattern matched.
    """
    sep = "\x01"
    joined = F.regexp_replace(F.translate(line, sep, "\ufffd"), pattern, sep.join(f"${i}" for i in range(1, n + 1)))
    return F.when(joined.contains(sep), F.split(joined, sep, n))


def classify(message: Column) -> Column:
    return (
        F.when(message.contains("Failed") | message.contains("Invalid"), "failed_login")
        .when(message.contains("Accepted"), "successful_login")
        .when(message.contains("Disconnected") | F.lower(message).contains("session closed"), "logout")
        .otherwise("unknown")
    )


# Each format has two steps: cutting the line into raw parts, and turning the parts into the event struct
# (null where the line is rejected). They run as separate projections so that a regex runs once per line.


def cut_syslog(line: Column, options: dict) -> Column:
    return _groups(line, SYSLOG, 4)


def syslog(parts: Column, options: dict) -> Column:
    """The line carries no year, so the job names one. ``strict_user`` skips the words user / invalid."""
    stamp = F.regexp_replace(parts[0], r"(?U)\s+", " ")
    ts = F.try_to_timestamp(F.concat(F.lit(f"{options['year']} "), stamp), F.lit("yyyy MMM d HH:mm:ss"))
    message = parts[3]
    user = F.regexp_extract(message, STRICT_USERNAME if options.get("strict_user") else USERNAME, 1)
    return _entry(
        ts.isNotNull(),
        timestamp=ts,
        hostname=parts[1],
        service=parts[2],
        event_type=classify(message),
        username=F.nullif(user, F.lit("")),
        ip_address=F.nullif(F.regexp_extract(message, IP, 0), F.lit("")),
        message=message,
    )


def cut_json(line: Column, options: dict) -> Column:
    return F.when(line.startswith("{"), F.from_json(line, "map<string,string>"))


def json_line(record: Column, options: dict) -> Column:
    """``mappings`` is {standard column: name in the log}; a mapped name absent from the line gives null."""
    mappings = options.get("mappings") or {}

    def field(name: str) -> Column:
        if name in mappings:
            return record[mappings[name]]
        if name == "event_type":
            return F.when(F.map_contains_key(record, name), record[name]).otherwise("unknown")
        return record[name] if name in ("timestamp", "username", "ip_address") else F.lit(None).cast("string")

    stamp = field("timestamp")
    ts = F.try_to_timestamp(stamp, F.lit(options["time_format"]))
    bad_time = (F.coalesce(stamp, F.lit("")) != "") & ts.isNull()
    fields = {name: field(name) for name in FIELDS if name != "timestamp"}
    return _entry(record.isNotNull() & ~bad_time, timestamp=ts, **fields)


def cut_csv(line: Column, options: dict) -> Column:
    return F.split(line, "\\Q" + options.get("delimiter", ",") + "\\E")


def csv_line(parts: Column, options: dict) -> Column:
    """timestamp, username, address, event type, message; a literal split, further fields are ignored."""
    ts = F.try_to_timestamp(F.get(parts, F.lit(0)), F.lit(options["time_format"]))
    return _entry(
        (F.size(parts) >= 5) & ts.isNotNull(),
        timestamp=ts,
        username=F.get(parts, F.lit(1)),
        ip_address=F.get(parts, F.lit(2)),
        event_type=F.get(parts, F.lit(3)),
        message=F.get(parts, F.lit(4)),
    )


def cut_apache(line: Column, options: dict) -> Column:
    return _groups(line, APACHE_SHORT if options.get("short_access") else APACHE, 4)


def apache(parts: Column, options: dict) -> Column:
    """Access-log line with referrer and agent; ``short_access`` takes lines without them. The zone is dropped."""
    ip, user, stamp, status = (parts[i] for i in range(4))
    ts = F.try_to_timestamp(F.substring_index(stamp, " ", 1), F.lit("dd/MMM/yyyy:HH:mm:ss"))
    kind = (
        F.when(status.startswith("4") | status.startswith("5"), "failed_access")
        .when(status.startswith("2"), "successful_access")
        .otherwise("access")
    )
    return _entry(
        ts.isNotNull(),
        timestamp=ts,
        username=F.when(user != "-", user),
        ip_address=ip,
        event_type=kind,
        message=F.concat(F.lit("Status: "), status),
    )


PARSERS = {
    "syslog": (cut_syslog, syslog),
    "json": (cut_json, json_line),
    "csv": (cut_csv, csv_line),
    "apache_common": (cut_apache, apache),
    "apache_combined": (cut_apache, apache),
}


def parse(
    lines: DataFrame,
    fmt: str = "auto",
    year: int = 1970,
    line: str = "line",
    time_format: str = TIME_FORMAT,
    **options,
) -> DataFrame:
    """Add the event columns and ``detected_format`` to each non-blank line; null format means rejected.

    ``auto`` takes the first format, in the order of ``FORMATS``, that accepts the line.
    """
    if fmt != "auto" and fmt not in PARSERS:
        raise ValueError(f"Unsupported log format: {fmt}")
    options = options | {"year": year, "time_format": time_format}
    rows = lines.withColumn(line, F.btrim(F.col(line), F.lit(BLANKS))).where(F.col(line) != "")
    formats = FORMATS if fmt == "auto" else [fmt]
    rows = rows.withColumns({f"_parts_{f}": PARSERS[f][0](F.col(line), options) for f in formats})
    rows = rows.withColumns({f"_event_{f}": PARSERS[f][1](F.col(f"_parts_{f}"), options) for f in formats})
    found = [
        F.when(F.col(f"_event_{f}").isNotNull(), F.struct(F.lit(f).alias("fmt"), F.col(f"_event_{f}").alias("e")))
        for f in formats
    ]
    # filters on the parsed columns stop at the generator; pushed further down they would repeat every regex
    rows = rows.select(*lines.columns, F.explode(F.array(F.coalesce(*found))).alias("_found"))
    return rows.select(
        *lines.columns,
        F.col("_found.fmt").alias("detected_format"),
        *[F.col(f"_found.e.{f}").alias(f) for f in FIELDS],
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("detected_format").isNotNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejected lines, whole, so that they can be parsed again."""
    keep = [c for c in parsed.columns if c not in (*FIELDS, "detected_format")]
    return parsed.where(F.col("detected_format").isNull()).select(*keep)


def quarantine(parsed: DataFrame, line: str = "line", head: int = 100) -> DataFrame:
    """Rejected lines, cut to ``head`` characters for the report."""
    lines = rejected(parsed)
    return lines.select(*[c for c in lines.columns if c != line], F.substring(line, 1, head).alias("line_head"))


def strict(parsed: DataFrame) -> DataFrame:
    """Events with user and address only; a syslog "invalid user" is the user ``invalid``."""
    invalid = (F.col("detected_format") == "syslog") & F.lower("message").contains("invalid user")
    return (
        accepted(parsed)
        .withColumn("username", F.when(invalid, F.lit("invalid")).otherwise(F.col("username")))
        .dropna(subset=["username", "ip_address"])
    )


def read_lines(spark: SparkSession, *paths: str, glob: str = "*.{log,txt}") -> DataFrame:
    """(line, file, event_id) of the files, or of all matching files in the folders.

    The id is a hash of the file, the block of the file that is read and the line's row in its task, so equal lines
    have different ids and a rerun over the same files with the same split settings has the same ids.
    """
    text = spark.read.option("pathGlobFilter", glob).text(list(paths))
    place = ["_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()]
    return text.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.xxhash64(*place).alias("event_id"),
    )


def read_logs(spark: SparkSession, *paths: str, fmt: str = "auto", year: int = 1970, **options) -> DataFrame:
    """Events of log files; sort at the sink only, with ``orderBy('timestamp')``."""
    return accepted(parse(read_lines(spark, *paths), fmt, year, **options))
