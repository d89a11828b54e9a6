"""DuckDB oracle per registered query."""

from __future__ import annotations

from signwatch.plans.oracle_base import LINES, oracle

ORACLES: dict[str, str] = {}

EV = ["auth_events"]

# --- detectors -------------------------------------------------------------------------------------------

KNOWN = "SELECT *, epoch_us(timestamp) AS us FROM auth_events WHERE username IS NOT NULL"

FREQ = {
    "known": KNOWN,
    "counts": """
  SELECT *, count(*) OVER (PARTITION BY username ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS recent FROM known""",
    "limits": "SELECT username, avg(recent) + 3 * stddev_pop(recent) AS lim FROM counts GROUP BY username HAVING count(*) > 1",
    "freq": """
  SELECT event_id, timestamp, username, ip_address, event_type, 'high_frequency' AS anomaly_type,
    CASE WHEN recent > 2 * lim THEN 'high' ELSE 'medium' END AS severity,
    'Login frequency (' || recent || ') exceeds threshold (' || format('{:.2f}', lim) || ')' AS details
  FROM counts JOIN limits USING (username) WHERE recent > lim""",
}
TIME = {
    "modal": """
  SELECT username, hour AS typical, n FROM (
    SELECT *, row_number() OVER (PARTITION BY username ORDER BY n DESC, hour) AS r FROM (
      SELECT username, hour(timestamp) AS hour, count(*) AS n FROM known GROUP BY ALL)) WHERE r = 1""",
    "gaps": """
  SELECT *, least(abs(hour(timestamp) - typical), 24 - abs(hour(timestamp) - typical)) AS gap FROM known JOIN modal USING (username)""",
    "times": """
  SELECT event_id, timestamp, username, ip_address, event_type, 'unusual_time' AS anomaly_type, 'medium' AS severity,
    'Login at hour ' || hour(timestamp) || ' differs from typical hour ' || typical || ' by ' || gap || ' hours' AS details
  FROM gaps WHERE gap > 2""",
}
ELAPSED = """(d // 86400000000) || ' days ' || lpad(CAST((d // 3600000000) % 24 AS VARCHAR), 2, '0') || ':'
    || lpad(CAST((d // 60000000) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((d // 1000000) % 60 AS VARCHAR), 2, '0')
    || CASE WHEN d % 1000000 > 0 THEN '.' || lpad(CAST(d % 1000000 AS VARCHAR), 6, '0') ELSE '' END"""
LOCATION = {
    "steps": """
  SELECT *, lag(ip_address) OVER w AS prev_ip, lag(us) OVER w AS prev_us, us - lag(us) OVER w AS d
  FROM known WINDOW w AS (PARTITION BY username ORDER BY us, event_id)""",
    "moves": f"""
  SELECT event_id, timestamp, username, ip_address, event_type, 'location_change' AS anomaly_type, 'medium' AS severity,
    'Rapid IP change from ' || coalesce(prev_ip, 'None') || ' to ' || coalesce(ip_address, 'None') || ' in ' || {ELAPSED} AS details
  FROM steps WHERE prev_us IS NOT NULL AND prev_ip IS DISTINCT FROM ip_address AND d < 3600000000""",
}
UNION = {
    "found": """
  SELECT *, CAST(1 AS BIGINT) AS priority FROM freq UNION ALL SELECT *, 2 FROM times UNION ALL SELECT *, 3 FROM moves""",
    "deduped": """
  SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, username, ip_address ORDER BY priority, event_id) AS r
    FROM found) WHERE r = 1""",
}
DETECT = FREQ | TIME | LOCATION | UNION

ORACLES["high_frequency"] = oracle(EV, FREQ, "SELECT * FROM freq")
ORACLES["logins_24h"] = oracle(EV, FREQ, "SELECT event_id, username, timestamp, recent AS logins FROM counts")
ORACLES["typical_hour"] = oracle(EV, {"known": KNOWN} | TIME, "SELECT username, typical AS typical_hour, n FROM modal")
ORACLES["unusual_time"] = oracle(EV, {"known": KNOWN} | TIME, "SELECT * FROM times")
ORACLES["location_change"] = oracle(EV, {"known": KNOWN} | LOCATION, "SELECT * FROM moves")
ORACLES["all_anomalies"] = oracle(EV, DETECT, "SELECT * FROM found")
ORACLES["dedup_anomalies"] = oracle(EV, DETECT, "SELECT * FROM deduped")
ORACLES["detect_anomalies"] = oracle(EV, DETECT, "SELECT * EXCLUDE (priority) FROM deduped")

SIMPLE = {
    "known": KNOWN,
    "avg_hours": "SELECT username, avg(hour(timestamp)) AS m FROM known GROUP BY username",
    "stime": """
  SELECT event_id, timestamp, username, ip_address, event_type, 'unusual_time' AS anomaly_type, 'medium' AS severity,
    'Login at hour ' || hour(timestamp) || ' differs from typical hour ' || format('{:.1f}', m) || ' by '
      || CAST(abs(hour(timestamp) - m) AS VARCHAR) || ' hours' AS details
  FROM known JOIN avg_hours USING (username) WHERE abs(hour(timestamp) - m) > 6""",
    "top3": """
  SELECT username, ip_address FROM (
    SELECT *, row_number() OVER (PARTITION BY username ORDER BY n DESC, ip_address) AS r FROM (
      SELECT username, ip_address, count(*) AS n FROM known WHERE ip_address IS NOT NULL GROUP BY ALL)) WHERE r <= 3""",
    "sloc": """
  SELECT event_id, timestamp, username, ip_address, event_type, 'unusual_location' AS anomaly_type, 'high' AS severity,
    'Login from unusual IP ' || coalesce(ip_address, 'None') || ' for user ' || username AS details
  FROM known k WHERE NOT EXISTS (SELECT 1 FROM top3 t WHERE t.username = k.username AND t.ip_address = k.ip_address)
    AND username IN (SELECT username FROM top3)""",
    "failed": """
  SELECT *, lead(us, 4) OVER w AS us5, lead(event_id, 4) OVER w AS id5, lead(timestamp, 4) OVER w AS ts5, count(*) OVER (PARTITION BY username) AS failures
  FROM known WHERE event_type = 'failed_login' WINDOW w AS (PARTITION BY username ORDER BY us, event_id)""",
    "sbrute": """
  SELECT id5 AS event_id, ts5 AS timestamp, username, ip_address, 'failed_login' AS event_type, 'brute_force' AS anomaly_type, 'high' AS severity,
    'Rapid succession of ' || failures || ' failed login attempts for user ' || username AS details
  FROM (SELECT *, row_number() OVER (PARTITION BY username ORDER BY us, event_id) AS r FROM failed WHERE us5 - us < 86400000000) WHERE r = 1""",
}
ORACLES["unusual_time_simple"] = oracle(EV, SIMPLE, "SELECT * FROM stime")
ORACLES["unusual_location"] = oracle(EV, SIMPLE, "SELECT * FROM sloc")
ORACLES["brute_force"] = oracle(EV, SIMPLE, "SELECT * FROM sbrute")
ORACLES["dedup_simple"] = oracle(
    EV,
    SIMPLE,
    """SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp, username ORDER BY priority, event_id) AS r FROM (
    SELECT *, CAST(1 AS BIGINT) AS priority FROM stime UNION ALL SELECT *, 2 FROM sloc UNION ALL SELECT *, 3 FROM sbrute)) WHERE r = 1""",
)
ORACLES["new_ip_flag"] = oracle(
    EV,
    {"known": KNOWN},
    """SELECT event_id, username, ip_address,
  CAST(CASE WHEN row_number() OVER (PARTITION BY username, ip_address ORDER BY us, event_id) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_new_ip
FROM known WHERE ip_address IS NOT NULL""",
)
SEQUENCE = {
    "known": KNOWN,
    "seq_gaps": "SELECT *, (us - lag(us) OVER (PARTITION BY username ORDER BY us, event_id)) / 1e6 AS gap FROM known",
    "seq_stats": """
  SELECT *, avg(gap) OVER w AS m, stddev_pop(gap) OVER w AS s, row_number() OVER (PARTITION BY username ORDER BY us, event_id) AS r
  FROM seq_gaps WINDOW w AS (PARTITION BY username ORDER BY us, event_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
    "seq": """
  SELECT event_id, timestamp, username, ip_address, event_type, 'sequential_timing' AS anomaly_type, 'medium' AS severity,
    'Unusual time gap in sequence for user ' || username AS details
  FROM seq_stats WHERE r > 5 AND m > 0 AND abs(gap - m) > 3 * s""",
}
ORACLES["sequential_timing"] = oracle(EV, SEQUENCE, "SELECT * FROM seq")
ORACLES["time_since_last"] = oracle(
    EV,
    {"known": KNOWN},
    """SELECT event_id, username, timestamp,
  round(coalesce((us - lag(us) OVER (PARTITION BY username ORDER BY us, event_id)) / 3600000000.0, 0), 6) AS hours_since_last FROM known""",
)

# --- reports ---------------------------------------------------------------------------------------------

ORACLES["anomaly_report"] = oracle(
    EV,
    DETECT,
    """SELECT 'total' AS section, 'all' AS key, count(*) AS n FROM deduped
UNION ALL SELECT 'severity', severity, count(*) FROM deduped GROUP BY severity
UNION ALL SELECT 'type', anomaly_type, count(*) FROM deduped GROUP BY anomaly_type
UNION ALL SELECT 'day', CAST(CAST(timestamp AS DATE) AS VARCHAR), count(*) FROM deduped GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'top_users', username, count(*) AS n FROM deduped GROUP BY username ORDER BY n DESC, username LIMIT 10)""",
)

# --- sources ---------------------------------------------------------------------------------------------

SYSLOG_RE = r"^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+)\[\d+\]:\s+(.*)"
APACHE_RE = r'^(\S+) \S+ (\S+) \[(.+?)\] ".+?" (\d{3}) \S+ "(.*?)" "(.*?)"'
IP_RE = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"


def syslog_cte(lines: str) -> str:
    return f"""
  SELECT event_id, 'syslog' AS detected_format, try_strptime('2024 ' || regexp_extract(line, '{SYSLOG_RE}', 1), '%Y %b %d %H:%M:%S') AS timestamp,
    regexp_extract(line, '{SYSLOG_RE}', 2) AS hostname, regexp_extract(line, '{SYSLOG_RE}', 3) AS service,
    CASE WHEN contains(m, 'Failed') OR contains(m, 'Invalid') THEN 'failed_login' WHEN contains(m, 'Accepted') THEN 'successful_login'
      WHEN contains(m, 'Disconnected') OR contains(lower(m), 'session closed') THEN 'logout' ELSE 'unknown' END AS event_type,
    nullif(regexp_extract(m, '(?:for|user)\\s+(\\w+)', 1), '') AS username, nullif(regexp_extract(m, '{IP_RE}', 0), '') AS ip_address, m AS message
  FROM (SELECT *, regexp_extract(line, '{SYSLOG_RE}', 4) AS m FROM {lines} WHERE regexp_matches(line, '{SYSLOG_RE}'))"""


def json_cte(lines: str) -> str:
    return f"""
  SELECT event_id, 'json' AS detected_format, try_strptime(json_extract_string(j, '$.timestamp'), '%Y-%m-%d %H:%M:%S') AS timestamp,
    CAST(NULL AS VARCHAR) AS hostname, CAST(NULL AS VARCHAR) AS service, coalesce(json_extract_string(j, '$.event_type'), 'unknown') AS event_type,
    json_extract_string(j, '$.username') AS username, json_extract_string(j, '$.ip_address') AS ip_address, CAST(NULL AS VARCHAR) AS message
  FROM (SELECT event_id, CAST(line AS JSON) AS j FROM {lines} WHERE json_valid(line))"""


def csv_cte(lines: str) -> str:
    return f"""
  SELECT event_id, 'csv' AS detected_format, try_strptime(f[1], '%Y-%m-%d %H:%M:%S') AS timestamp,
    CAST(NULL AS VARCHAR) AS hostname, CAST(NULL AS VARCHAR) AS service, f[4] AS event_type, f[2] AS username, f[3] AS ip_address, f[5] AS message
  FROM (SELECT event_id, string_split(line, ',') AS f FROM {lines})
  WHERE len(f) >= 5 AND try_strptime(f[1], '%Y-%m-%d %H:%M:%S') IS NOT NULL"""


def apache_cte(lines: str, name: str) -> str:
    return f"""
  SELECT event_id, '{name}' AS detected_format,
    try_strptime(string_split(regexp_extract(line, '{APACHE_RE}', 3), ' ')[1], '%d/%b/%Y:%H:%M:%S') AS timestamp,
    CAST(NULL AS VARCHAR) AS hostname, CAST(NULL AS VARCHAR) AS service,
    CASE WHEN code[1] IN ('4', '5') THEN 'failed_access' WHEN code[1] = '2' THEN 'successful_access' ELSE 'access' END AS event_type,
    nullif(regexp_extract(line, '{APACHE_RE}', 2), '-') AS username, regexp_extract(line, '{APACHE_RE}', 1) AS ip_address, 'Status: ' || code AS message
  FROM (SELECT *, regexp_extract(line, '{APACHE_RE}', 4) AS code FROM {lines} WHERE regexp_matches(line, '{APACHE_RE}'))"""


def all_formats(lines: str) -> dict[str, str]:
    return {
        "p_sys": syslog_cte(lines),
        "p_json": json_cte(lines),
        "p_csv": csv_cte(lines),
        "p_apache": apache_cte(lines, "apache_common"),
        "parsed": "SELECT * FROM p_sys UNION ALL SELECT * FROM p_json UNION ALL SELECT * FROM p_csv UNION ALL SELECT * FROM p_apache",
    }


ORACLES["parse_syslog"] = oracle(EV + ["syslog_lines"], {"p": syslog_cte("syslog_lines")}, "SELECT * FROM p")
ORACLES["parse_json"] = oracle(EV + ["json_lines"], {"p": json_cte("json_lines")}, "SELECT * FROM p")
ORACLES["parse_csv"] = oracle(EV + ["csv_lines"], {"p": csv_cte("csv_lines")}, "SELECT * FROM p")
ORACLES["parse_apache"] = oracle(EV + ["apache_lines"], {"p": apache_cte("apache_lines", "apache_combined")}, "SELECT * FROM p")
ORACLES["parse_auto"] = oracle(EV + LINES, all_formats("mixed_lines"), "SELECT * FROM parsed")
ORACLES["quarantine"] = oracle(
    EV + LINES,
    all_formats("mixed_lines"),
    "SELECT event_id, substr(line, 1, 100) AS line_head FROM mixed_lines WHERE event_id NOT IN (SELECT event_id FROM parsed)",
)
ORACLES["multi_source_union"] = oracle(
    EV + LINES[:4],
    {
        "p_sys": syslog_cte("syslog_lines"),
        "p_json": json_cte("json_lines"),
        "p_csv": csv_cte("csv_lines"),
        "p_apache": apache_cte("apache_lines", "apache_common"),
    },
    """SELECT * EXCLUDE (hostname, service, message) FROM (
  SELECT * FROM p_sys UNION ALL SELECT * FROM p_json UNION ALL SELECT * FROM p_csv UNION ALL SELECT * FROM p_apache)""",
)
ORACLES["strict_ingest"] = oracle(
    EV + ["syslog_lines"],
    {"p": syslog_cte("syslog_lines")},
    """SELECT * FROM (SELECT * EXCLUDE (detected_format) REPLACE (CASE WHEN contains(lower(message), 'invalid user') THEN 'invalid' ELSE username END AS username) FROM p)
WHERE username IS NOT NULL AND ip_address IS NOT NULL""",
)
ORACLES["event_class_counts"] = oracle(
    EV + ["syslog_lines"], {"p": syslog_cte("syslog_lines")}, "SELECT event_type, count(*) AS n FROM p GROUP BY event_type"
)

# --- features --------------------------------------------------------------------------------------------


def md5_bucket(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT % 10000"


PRIVATE = "coalesce(starts_with(ip_address, '10.') OR starts_with(ip_address, '172.') OR starts_with(ip_address, '192.168.'), false)::INT::BIGINT"
CODE = "CASE event_type WHEN 'successful_login' THEN 1 WHEN 'failed_login' THEN 0 WHEN 'logout' THEN 2 WHEN 'access' THEN 3 ELSE -1 END::BIGINT"
CODE3 = "CASE event_type WHEN 'successful_login' THEN 1 WHEN 'failed_login' THEN 0 WHEN 'logout' THEN 2 ELSE -1 END::BIGINT"
USER_CODE = "dense_rank() OVER (ORDER BY coalesce(username, 'None')) - 1"
FEATURES = {
    "feats": f"""
  SELECT event_id, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
    {USER_CODE} AS username_encoded, coalesce({md5_bucket("ip_address")}, -1) AS ip_hash, {CODE} AS event_type_encoded,
    hour(timestamp) * ({USER_CODE}) AS hour_username_interaction
  FROM auth_events"""
}
ML = ["hour", "day_of_week", "day_of_month", "month", "username_encoded", "ip_hash", "event_type_encoded", "hour_username_interaction"]

ORACLES["calendar_features"] = oracle(
    EV,
    {},
    """SELECT event_id, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
  minute(timestamp) AS minute FROM auth_events""",
)
ORACLES["event_code"] = oracle(EV, {}, f"SELECT event_id, {CODE} AS event_code, {CODE3} AS event_code_client FROM auth_events")
ORACLES["hash_bucket"] = oracle(
    EV,
    {},
    f"""SELECT event_id, coalesce({md5_bucket("ip_address")}, -1) AS ip_hash, {md5_bucket("coalesce(username, 'None')")} AS username_hash FROM auth_events""",
)
ORACLES["private_ip"] = oracle(
    EV,
    {},
    f"""SELECT event_id, {PRIVATE} AS is_private_ip,
  coalesce(regexp_matches(ip_address, '^(10[.]|192[.]168[.]|172[.](1[6-9]|2[0-9]|3[01])[.])'), false)::INT::BIGINT AS is_rfc1918 FROM auth_events""",
)
ORACLES["label_encode"] = oracle(EV, {}, f"SELECT event_id, username, {USER_CODE} AS username_encoded FROM auth_events")
ORACLES["interaction"] = oracle(EV, FEATURES, "SELECT event_id, hour_username_interaction FROM feats")
ORACLES["ml_features"] = oracle(EV, FEATURES, "SELECT * FROM feats")
ORACLES["ml_features_simple"] = oracle(
    EV,
    {},
    """SELECT event_id, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, minute(timestamp) AS minute,
  dense_rank() OVER (ORDER BY coalesce(username, 'unknown')) - 1 AS username_encoded,
  dense_rank() OVER (ORDER BY coalesce(ip_address, '0.0.0.0')) - 1 AS ip_encoded,
  dense_rank() OVER (ORDER BY coalesce(event_type, 'unknown')) - 1 AS event_encoded FROM auth_events""",
)
ORACLES["scaled_features"] = oracle(
    EV,
    FEATURES | {"stats": "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ML) + " FROM feats"},
    "SELECT event_id, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) + 0.0 AS {c}" for c in ML)
    + " FROM feats, stats",
)
ORACLES["fed_features"] = oracle(
    EV + ["client_events"],
    {},
    f"""SELECT event_id, client_id, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
  {md5_bucket("coalesce(username, 'None')")} AS username_hash, {md5_bucket("coalesce(ip_address, 'None')")} AS ip_hash, {PRIVATE} AS is_private_ip,
  {CODE3} AS event_type_encoded, hour(timestamp) * ({md5_bucket("coalesce(username, 'None')")}) AS hour_username_interaction FROM client_events""",
)
ORACLES["xai_features"] = oracle(
    EV,
    {"known": KNOWN, "peruser": "SELECT username, count(*) AS login_count, (max(us) - min(us)) / 86400000000.0 AS active_days FROM known GROUP BY username"},
    f"""SELECT event_id, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
  minute(timestamp) AS minute,
  round(CASE WHEN username IS NULL THEN 0 ELSE coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY username ORDER BY timestamp, event_id)) / 3600000000.0, 0) END, 6) AS hours_since_last,
  {USER_CODE} AS username_encoded, dense_rank() OVER (ORDER BY coalesce(ip_address, 'None')) - 1 AS ip_encoded, {PRIVATE} AS is_private_ip,
  {CODE} AS event_type_encoded, hour(timestamp) * ({USER_CODE}) AS hour_username_interaction, coalesce(login_count, 0) AS login_count,
  round(coalesce(active_days, 0), 6) AS active_days
FROM auth_events LEFT JOIN peruser USING (username)""",
)

# --- profiles --------------------------------------------------------------------------------------------

HISTORY = "SELECT *, epoch_us(timestamp) AS us FROM auth_events WHERE username IS NOT NULL AND timestamp < TIMESTAMP '2024-01-16'"
RECENT = "SELECT *, epoch_us(timestamp) AS us FROM auth_events WHERE username IS NOT NULL AND timestamp >= TIMESTAMP '2024-01-16'"


def sessions_cte(rows: str) -> str:
    return f"""
  SELECT l.event_id, l.username, l.timestamp, (min(o.us) - l.us) / 3600000000.0 AS hours
  FROM {rows} l JOIN {rows} o ON o.username = l.username AND o.us > l.us AND o.event_type = 'logout'
  WHERE l.event_type = 'successful_login' GROUP BY l.event_id, l.username, l.timestamp, l.us"""


def profile_cte(rows: str) -> str:
    return f"""
  SELECT username, count(*) AS n_events, round(avg(hour(timestamp)), 6) AS login_hour_avg,
    string_agg(DISTINCT CAST(isodow(timestamp) - 1 AS VARCHAR), ',' ORDER BY CAST(isodow(timestamp) - 1 AS VARCHAR)) AS preferred_days,
    count(DISTINCT ip_address) AS n_locations,
    round(count(*) / CASE WHEN (max(us) - min(us)) // 86400000000 > 0 THEN (max(us) - min(us)) // 86400000000 ELSE 1 END, 6) AS login_frequency_per_day,
    round(avg(CASE WHEN event_type = 'successful_login' THEN 1.0 ELSE 0 END), 6) AS success_rate
  FROM {rows} GROUP BY username"""


ORACLES["session_durations"] = oracle(
    EV,
    {"known": KNOWN, "sess": sessions_cte("known")},
    "SELECT event_id, username, timestamp, round(hours, 6) AS session_hours FROM sess",
)
ORACLES["user_profiles"] = oracle(
    EV,
    {
        "known": KNOWN,
        "sess": sessions_cte("known"),
        "prof": profile_cte("known"),
        "mean_sess": "SELECT username, round(avg(hours), 6) AS session_hours_avg FROM sess GROUP BY username",
    },
    "SELECT prof.*, session_hours_avg FROM prof LEFT JOIN mean_sess USING (username)",
)
ORACLES["user_locations"] = oracle(
    EV,
    {"known": KNOWN},
    "SELECT username, ip_address, count(*) AS n, min(timestamp) AS first_seen FROM known WHERE ip_address IS NOT NULL GROUP BY ALL",
)
ORACLES["profile_merge"] = oracle(
    EV,
    {
        "known": KNOWN,
        "old": HISTORY,
        "new": RECENT,
        "sess1": sessions_cte("old"),
        "sess2": sessions_cte("new"),
        "prof": profile_cte("known"),
        "mean_sess": """
  SELECT username, round(avg(hours), 6) AS session_hours_avg FROM (SELECT * FROM sess1 UNION ALL SELECT * FROM sess2) GROUP BY username""",
    },
    "SELECT prof.*, session_hours_avg FROM prof LEFT JOIN mean_sess USING (username)",
)
SIMPLE_PROFILE = """
  SELECT username, count(*) AS n_events, avg(hour(timestamp)) AS login_hour_avg,
    string_agg(DISTINCT CAST(isodow(timestamp) - 1 AS VARCHAR), ',' ORDER BY CAST(isodow(timestamp) - 1 AS VARCHAR)) AS preferred_days,
    count(DISTINCT ip_address) AS n_locations, count(*) / ((max(us) - min(us)) // 86400000000 + 1) AS login_frequency_per_day,
    avg(CASE WHEN event_type = 'successful_login' THEN 1.0 ELSE 0 END) AS success_rate,
    count(*) FILTER (WHERE event_type = 'failed_login' AND timestamp > {as_of} - INTERVAL 24 HOUR) AS failed_attempts_recent
  FROM {rows} GROUP BY username"""
ORACLES["user_profiles_simple"] = oracle(
    EV,
    {"known": KNOWN, "prof": SIMPLE_PROFILE.format(rows="known", as_of="TIMESTAMP '2024-01-31'")},
    """SELECT * REPLACE (round(login_hour_avg, 6) AS login_hour_avg, round(login_frequency_per_day, 6) AS login_frequency_per_day,
  round(success_rate, 6) AS success_rate) FROM prof""",
)
ORACLES["failed_times"] = oracle(
    EV, {"known": KNOWN}, "SELECT username, event_id, timestamp AS failed_at FROM known WHERE event_type = 'failed_login'"
)
LOC_KNOWN = "SELECT DISTINCT username, ip_address, true AS seen FROM old WHERE ip_address IS NOT NULL"
ORACLES["similarity"] = oracle(
    EV,
    {
        "old": HISTORY,
        "new": RECENT,
        "prof": """
  SELECT username, avg(hour(timestamp)) AS h, list(DISTINCT isodow(timestamp)) AS days, count(DISTINCT ip_address) AS ips FROM old GROUP BY username""",
        "loc": LOC_KNOWN,
        "parts": """
  SELECT event_id, username, h, greatest(0.0, 1 - abs(hour(timestamp) - h) / 12) AS p1, CASE WHEN ips > 0 THEN CASE WHEN seen THEN 1.0 ELSE 0.3 END END AS p2,
    CASE WHEN list_contains(days, isodow(timestamp)) THEN 1.0 ELSE 0.5 END AS p3
  FROM new LEFT JOIN prof USING (username) LEFT JOIN loc USING (username, ip_address)""",
    },
    """SELECT event_id, username, round(CASE WHEN h IS NULL THEN 0 ELSE (p1 + coalesce(p2, 0) + p3) / (CASE WHEN p2 IS NULL THEN 2 ELSE 3 END) END, 6) AS similarity FROM parts""",
)
ORACLES["behavior_change"] = oracle(
    EV,
    {
        "known": KNOWN,
        "stats": """
  SELECT username, avg(hour(timestamp)) FILTER (WHERE timestamp < TIMESTAMP '2024-01-16') AS bm, stddev_pop(hour(timestamp)) FILTER (WHERE timestamp < TIMESTAMP '2024-01-16') AS s,
    avg(hour(timestamp)) FILTER (WHERE timestamp >= TIMESTAMP '2024-01-16') AS rm, date_diff('day', min(timestamp)::DATE, DATE '2024-01-31') AS age
  FROM known GROUP BY username""",
        "zs": "SELECT *, CASE WHEN s > 0 THEN abs(rm - bm) / s END AS z FROM stats",
    },
    """SELECT username, age AS profile_age_days, round(bm, 6) AS baseline_mean, round(rm, 6) AS recent_mean, round(z, 6) AS z_score,
  coalesce(z > 2, false)::INT::BIGINT AS behavior_changed FROM zs""",
)
ORACLES["login_check"] = oracle(
    EV,
    {
        "old": HISTORY,
        "new": RECENT,
        "prof": SIMPLE_PROFILE.format(rows="old", as_of="TIMESTAMP '2024-01-16'"),
        "loc": LOC_KNOWN,
        "j": """
  SELECT *, abs(hour(timestamp) - login_hour_avg) AS apart, isodow(timestamp) - 1 AS dow FROM
    (SELECT event_id, username, timestamp, ip_address FROM new) LEFT JOIN prof USING (username) LEFT JOIN loc USING (username, ip_address)""",
        "v": """
  SELECT *, CASE WHEN login_hour_avg IS NULL THEN 1 WHEN apart > 4 THEN 2 WHEN NOT contains(preferred_days, CAST(dow AS VARCHAR)) THEN 3
    WHEN n_locations > 0 AND seen IS NULL THEN 4 WHEN failed_attempts_recent > 5 THEN 5 ELSE 6 END AS rule FROM j""",
    },
    """SELECT event_id, username, (rule < 6)::INT::BIGINT AS is_anomalous,
  CASE WHEN rule < 4 THEN 'medium' WHEN rule < 6 THEN 'high' ELSE 'normal' END AS severity,
  CASE rule WHEN 1 THEN 'No profile found for user ' || username
    WHEN 2 THEN 'Login at hour ' || hour(timestamp) || ' differs from typical hour ' || format('{:.1f}', login_hour_avg) || ' by ' || CAST(apart AS VARCHAR) || ' hours'
    WHEN 3 THEN 'Login on day ' || dow || ' (' || (['Mon','Tue','Wed','Thu','Fri','Sat','Sun'])[dow + 1] || ') is unusual for this user'
    WHEN 4 THEN 'Login from unusual location/IP: ' || coalesce(ip_address, 'None')
    WHEN 5 THEN 'High number of recent failed attempts (' || failed_attempts_recent || ') before this login'
    ELSE 'Login matches typical user behavior' END AS reason FROM v""",
)

# --- biometrics ------------------------------------------------------------------------------------------

KEYS, MICE = ["keystrokes"], ["mouse_events"]


def key_ctes(where: str, tag: str) -> dict[str, str]:
    return {
        f"k{tag}": f"SELECT *, epoch_us(timestamp) AS us FROM keystrokes WHERE {where}",
        f"hold{tag}": f"""
  SELECT d.event_id, d.username, d.session_id, (min(u.us) - d.us) / 1e6 AS hold FROM k{tag} d JOIN k{tag} u
    ON u.username = d.username AND u.session_id = d.session_id AND u.key = d.key AND u.keystroke_type = 'up' AND u.us > d.us
  WHERE d.keystroke_type = 'down' GROUP BY d.event_id, d.username, d.session_id, d.us""",
        f"fl{tag}": f"""
  SELECT event_id, username, session_id, CASE keystroke_type WHEN 'up' THEN 'flight' ELSE 'latency' END AS metric, (nus - us) / 1e6 AS seconds
  FROM (SELECT *, lead(keystroke_type) OVER w AS nt, lead(us) OVER w AS nus FROM k{tag} WINDOW w AS (PARTITION BY username, session_id ORDER BY us, event_id))
  WHERE nt = 'down'""",
        f"sp{tag}": f"""
  SELECT username, session_id, count(*) / ((max(us) - min(us)) / 60e6) AS speed FROM k{tag} GROUP BY username, session_id HAVING max(us) > min(us)""",
        f"ks{tag}": f"""
  SELECT username, session_id, 'hold' AS metric, hold AS value FROM hold{tag} UNION ALL SELECT username, session_id, metric, seconds FROM fl{tag}
  UNION ALL SELECT username, session_id, 'speed', speed FROM sp{tag}""",
    }


def profile_sql(samples: str, metrics: list[str], counted: str) -> str:
    columns = []
    for m in metrics:
        columns.append(f"coalesce(avg(value) FILTER (WHERE metric = '{m}'), 0) AS {m}_mean")
        if m not in ("turn", "efficiency"):
            columns.append(f"coalesce(stddev_samp(value) FILTER (WHERE metric = '{m}'), 0) AS {m}_std")
    return f"SELECT username, {', '.join(columns)}, count(*) FILTER (WHERE metric IN ({counted})) AS samples FROM {samples} GROUP BY username"


def rounded_profile(name: str, metrics: list[str]) -> str:
    places = {m: 3 if m in ("hold", "flight", "latency", "click") else 6 for m in metrics}
    columns = [f"round({m}_mean, {places[m]}) AS {m}_mean" for m in metrics]
    columns += [f"round({m}_std, {places[m]}) AS {m}_std" for m in metrics if m not in ("turn", "efficiency")]
    return f"SELECT username, {', '.join(columns)}, samples FROM {name}"


def means_sql(samples: str, metrics: list[str]) -> str:
    columns = ", ".join(f"avg(value) FILTER (WHERE metric = '{m}') AS now_{m}" for m in metrics)
    return f"SELECT username, session_id, {columns} FROM {samples} GROUP BY username, session_id"


def z_sql(m: str) -> str:
    return f"CASE WHEN {m}_std > 0 THEN abs(now_{m} - {m}_mean) / {m}_std END"


def score_sql(measures: str, checks: list[tuple[float, float, str]], normal: str, missing: str, confidence: float) -> str:
    """checks: (limit, weight, label) over the columns m0, m1, m2 of the table ``measures``."""
    score = " + ".join(f"CASE WHEN m{i} > {limit} THEN m{i} * {w} ELSE 0 END" for i, (limit, w, _) in enumerate(checks))
    notes = ", ".join(f"CASE WHEN m{i} > {limit} THEN '{label}' || format('{{:.2f}}', m{i}) END" for i, (limit, _, label) in enumerate(checks))
    return f"""
  SELECT username, session_id, CASE WHEN known THEN score > 1.0 ELSE true END AS is_anomaly,
    CASE WHEN known THEN least(score, 1.0) ELSE {confidence} END AS confidence, CASE WHEN known THEN score END AS anomaly_score,
    CASE WHEN NOT known THEN '{missing}' WHEN notes = '' THEN '{normal}' ELSE notes END AS details
  FROM (SELECT username, session_id, known, CAST({score} AS DOUBLE) AS score, concat_ws('; ', {notes}) AS notes FROM {measures})"""


KEY_METRICS = ["hold", "flight", "latency", "speed"]
MOUSE_METRICS = ["speed", "acceleration", "turn", "click", "efficiency"]


def mouse_ctes(where: str, tag: str) -> dict[str, str]:
    part = "PARTITION BY username, session_id ORDER BY us, event_id"
    return {
        f"m{tag}": f"SELECT *, epoch_us(timestamp) AS us FROM mouse_events WHERE {where}",
        f"st{tag}": f"""
  SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, (us - lag(us) OVER w) / 1e6 AS dt,
    lag(x) OVER w - lag(x, 2) OVER w AS px, lag(y) OVER w - lag(y, 2) OVER w AS py, (lag(us) OVER w - lag(us, 2) OVER w) / 1e6 AS pdt,
    lead(x) OVER w - x AS nx, lead(y) OVER w - y AS ny
  FROM m{tag} WHERE event_type = 'move' WINDOW w AS ({part})""",
        f"mv{tag}": f"""
  SELECT event_id, username, session_id, us, x, y, sqrt(dx * dx + dy * dy) AS step, CASE WHEN dt > 0 THEN sqrt(dx * dx + dy * dy) / dt END AS speed,
    CASE WHEN dt > 0 AND pdt > 0 THEN (sqrt(dx * dx + dy * dy) / dt - sqrt(px * px + py * py) / pdt) / dt END AS acceleration,
    CASE WHEN sqrt(dx * dx + dy * dy) * sqrt(nx * nx + ny * ny) > 0 THEN
      acos(greatest(-1.0, least(1.0, (dx * nx + dy * ny) / (sqrt(dx * dx + dy * dy) * sqrt(nx * nx + ny * ny))))) END AS angle
  FROM st{tag}""",
        f"cl{tag}": f"""
  SELECT * FROM (SELECT event_id, username, session_id, (us - lag(us) OVER ({part})) / 1e6 AS gap FROM m{tag} WHERE event_type = 'click') WHERE gap IS NOT NULL""",
        f"pe{tag}": f"""
  SELECT username, session_id, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / path AS efficiency FROM (
    SELECT username, session_id, first(x ORDER BY us, event_id) AS x1, first(y ORDER BY us, event_id) AS y1, last(x ORDER BY us, event_id) AS x2,
      last(y ORDER BY us, event_id) AS y2, sum(step) AS path FROM mv{tag} GROUP BY username, session_id) WHERE path > 0""",
        f"ms{tag}": f"""
  SELECT username, session_id, 'speed' AS metric, speed AS value FROM mv{tag} WHERE speed IS NOT NULL
  UNION ALL SELECT username, session_id, 'acceleration', acceleration FROM mv{tag} WHERE acceleration IS NOT NULL
  UNION ALL SELECT username, session_id, 'turn', angle FROM mv{tag} WHERE angle > pi() / 4
  UNION ALL SELECT username, session_id, 'click', gap FROM cl{tag} UNION ALL SELECT username, session_id, 'efficiency', efficiency FROM pe{tag}""",
    }


KEY_SCORE = (
    key_ctes("timestamp < TIMESTAMP '2024-01-20'", "0")
    | key_ctes("timestamp >= TIMESTAMP '2024-01-20'", "1")
    | {
        "kprof": profile_sql("ks0", KEY_METRICS, "'hold', 'flight', 'latency'"),
        "kmeasures": f"""
  SELECT s.username, s.session_id, p.username IS NOT NULL AS known, {z_sql("hold")} AS m0, {z_sql("flight")} AS m1, {z_sql("speed")} AS m2
  FROM ({means_sql("ks1", KEY_METRICS)}) s LEFT JOIN kprof p USING (username)""",
        "kscore": score_sql(
            "kmeasures",
            [
                (2, 0.3, "Hold time deviation: z-score "),
                (2, 0.3, "Flight time deviation: z-score "),
                (2, 0.4, "Typing speed deviation: z-score "),
            ],
            "Normal keystroke pattern",
            "No keystroke profile for user",
            0.9,
        ),
    }
)
MOUSE_SCORE = (
    mouse_ctes("timestamp < TIMESTAMP '2024-01-20'", "0")
    | mouse_ctes("timestamp >= TIMESTAMP '2024-01-20'", "1")
    | {
        "mprof": profile_sql("ms0", MOUSE_METRICS, "'speed', 'click'"),
        "mmeasures": f"""
  SELECT s.username, s.session_id, p.username IS NOT NULL AS known, {z_sql("speed")} AS m0, {z_sql("click")} AS m1,
    CASE WHEN efficiency_mean > 0 THEN abs(now_efficiency - efficiency_mean) / efficiency_mean END AS m2
  FROM ({means_sql("ms1", MOUSE_METRICS)}) s LEFT JOIN mprof p USING (username)""",
        "mscore": score_sql(
            "mmeasures",
            [
                (2, 0.4, "Mouse speed deviation: z-score "),
                (2, 0.3, "Click interval deviation: z-score "),
                (0.5, 0.3, "Path efficiency deviation: ratio "),
            ],
            "Normal mouse pattern",
            "No mouse profile for user",
            0.8,
        ),
    }
)
SCORE_COLUMNS = """SELECT username, session_id, is_anomaly::INT::BIGINT AS is_anomaly, round(confidence, 6) AS confidence,
  round(anomaly_score, 6) AS anomaly_score, details FROM """

ORACLES["key_hold_times"] = oracle(KEYS, key_ctes("true", ""), "SELECT * REPLACE (round(hold, 6) AS hold) FROM hold")
ORACLES["key_flight_latency"] = oracle(KEYS, key_ctes("true", ""), "SELECT * REPLACE (round(seconds, 6) AS seconds) FROM fl")
ORACLES["typing_speed"] = oracle(KEYS, key_ctes("true", ""), "SELECT * REPLACE (round(speed, 6) AS speed) FROM sp")
ORACLES["keystroke_profile"] = oracle(
    KEYS,
    key_ctes("true", "") | {"prof": profile_sql("ks", KEY_METRICS, "'hold', 'flight', 'latency'")},
    rounded_profile("prof", KEY_METRICS),
)
ORACLES["keystroke_anomaly"] = oracle(KEYS, KEY_SCORE, SCORE_COLUMNS + "kscore")
ORACLES["mouse_speed"] = oracle(
    MICE,
    mouse_ctes("true", ""),
    "SELECT event_id, username, session_id, round(speed, 6) AS speed, round(acceleration, 6) AS acceleration FROM mv WHERE speed IS NOT NULL",
)
ORACLES["mouse_turns"] = oracle(
    MICE, mouse_ctes("true", ""), "SELECT event_id, username, session_id, round(angle, 6) AS turn FROM mv WHERE angle > pi() / 4"
)
ORACLES["click_intervals"] = oracle(
    MICE, mouse_ctes("true", ""), "SELECT event_id, username, session_id, round(gap, 6) AS interval FROM cl"
)
ORACLES["path_efficiency"] = oracle(
    MICE, mouse_ctes("true", ""), "SELECT username, session_id, round(efficiency, 6) AS efficiency FROM pe"
)
ORACLES["mouse_profile"] = oracle(
    MICE,
    mouse_ctes("true", "") | {"prof": profile_sql("ms", MOUSE_METRICS, "'speed', 'click'")},
    rounded_profile("prof", MOUSE_METRICS),
)
ORACLES["mouse_anomaly"] = oracle(MICE, MOUSE_SCORE, SCORE_COLUMNS + "mscore")
ORACLES["biometric_session"] = oracle(
    KEYS + MICE,
    KEY_SCORE | MOUSE_SCORE,
    """SELECT username, session_id, (coalesce(k.is_anomaly, false) OR coalesce(m.is_anomaly, false))::INT::BIGINT AS overall_anomaly,
  round(greatest(CASE WHEN k.is_anomaly THEN k.confidence ELSE 0 END, CASE WHEN m.is_anomaly THEN m.confidence ELSE 0 END), 6) AS confidence,
  concat_ws('; ', 'Keystroke: ' || k.details, 'Mouse: ' || m.details) AS details
FROM kscore k FULL JOIN mscore m USING (username, session_id)""",
)

# --- explanations ----------------------------------------------------------------------------------------


def rules_sql(rows: str) -> str:
    return f"""
  SELECT r.*, concat_ws(' | ', CASE WHEN hour(timestamp) < 6 OR hour(timestamp) > 22 THEN 'Login at unusual time (' || hour(timestamp) || ':00)' END,
    CASE WHEN isodow(timestamp) >= 6 THEN 'Login on weekend' END,
    CASE WHEN p.username IS NOT NULL AND l.seen IS NULL THEN 'Login from new IP address: ' || coalesce(r.ip_address, 'None') END,
    CASE WHEN p.username IS NOT NULL THEN 'Activity pattern differs from baseline' END) AS rule_based
  FROM {rows} r LEFT JOIN (SELECT DISTINCT username FROM old) p ON p.username = r.username
  LEFT JOIN ({LOC_KNOWN}) l ON l.username = r.username AND l.ip_address = r.ip_address"""


SHARES = {
    "total": "SELECT count(*) AS total FROM auth_events",
    "hs": "SELECT hour(timestamp) AS v, count(*) AS n, count(*) / (SELECT total FROM total) AS share FROM auth_events GROUP BY 1",
    "ips": "SELECT ip_address AS v, count(*) AS n, count(*) / (SELECT total FROM total) AS share FROM auth_events WHERE ip_address IS NOT NULL GROUP BY 1",
    "us": "SELECT username AS v, count(*) AS n, count(*) / (SELECT total FROM total) AS share FROM auth_events WHERE username IS NOT NULL GROUP BY 1",
}


def rarity_sql(rows: str) -> str:
    return f"""
  SELECT r.*, concat_ws(' | ',
    CASE WHEN hs.share < 0.05 THEN 'Login at rare hour (' || hour(timestamp) || ':00, only ' || format('{{:.1f}}', hs.share * 100) || '% of logins occur at this time)' END,
    CASE WHEN coalesce(ips.share, 0) < 0.05 THEN 'Login from rare IP (' || coalesce(ip_address, 'None') || ', only ' || format('{{:.1f}}', coalesce(ips.share, 0.0) * 100)
      || '% of logins from this IP)' END,
    CASE WHEN coalesce(us.share, 0) < 0.01 THEN 'Rare user account (only ' || format('{{:.1f}}', coalesce(us.share, 0.0) * 100) || '% of all logins)' END) AS rarity
  FROM {rows} r LEFT JOIN hs ON hs.v = hour(timestamp) LEFT JOIN ips ON ips.v = ip_address LEFT JOIN us ON us.v = username"""


MATCH = DETECT | {
    "records": "SELECT timestamp, username, ip_address, min(event_id) AS record_id FROM auth_events GROUP BY ALL",
    "matched": "SELECT d.*, record_id FROM deduped d JOIN records USING (timestamp, username, ip_address)",
}
REPORT = MATCH | {"old": HISTORY} | SHARES | {"ruled": rules_sql("matched"), "report": rarity_sql("ruled")}

ORACLES["explain_match"] = oracle(EV, MATCH, "SELECT * EXCLUDE (priority) FROM matched")
ORACLES["explain_rules"] = oracle(
    EV, {"old": HISTORY, "new": "SELECT * FROM auth_events WHERE timestamp >= TIMESTAMP '2024-01-16'", "ruled": rules_sql("new")},
    "SELECT event_id, username, rule_based FROM ruled",
)
ORACLES["value_rarity"] = oracle(
    EV,
    SHARES,
    """SELECT 'hour' AS kind, CAST(v AS VARCHAR) AS value, n, round(share, 6) AS share FROM hs UNION ALL SELECT 'ip', v, n, round(share, 6) FROM ips
UNION ALL SELECT 'user', v, n, round(share, 6) FROM us""",
)
ORACLES["explain_rarity"] = oracle(EV, SHARES | {"r": rarity_sql("auth_events")}, "SELECT event_id, rarity FROM r")
ORACLES["explained_report"] = oracle(
    EV, REPORT, "SELECT event_id, record_id, anomaly_type, severity, rule_based, rarity FROM report"
)
ORACLES["explanation_summary"] = oracle(
    EV,
    REPORT | {"texts": "SELECT unnest(string_split(rule_based, ' | ')) AS key FROM report WHERE rule_based <> ''"},
    """SELECT 'total' AS section, 'all' AS key, count(*) AS n FROM report UNION ALL SELECT 'severity', severity, count(*) FROM report GROUP BY severity
UNION ALL SELECT * FROM (SELECT 'pattern', key, count(*) AS n FROM texts GROUP BY key ORDER BY n DESC, key LIMIT 5)""",
)

# --- alerts ----------------------------------------------------------------------------------------------

AL = ["auth_events", "alerts_input"]
MESSAGE = """CASE severity WHEN 'high' THEN 'HIGH SEVERITY ALERT: Suspicious activity detected for user ' || coalesce(username, 'Unknown')
  WHEN 'medium' THEN 'MEDIUM SEVERITY: Unusual activity detected for user ' || coalesce(username, 'Unknown')
  WHEN 'low' THEN 'LOW SEVERITY: Minor anomaly detected for user ' || coalesce(username, 'Unknown') ELSE 'ANOMALY DETECTED: ' || details END"""
STAMP = """CASE WHEN epoch_us(timestamp) % 1000000 = 0 THEN strftime(timestamp, '%Y-%m-%d %H:%M:%S') ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') END"""
SUBJECT = "'[' || upper(severity) || '] Security Alert: ' || coalesce(username, 'Unknown User')"
BODY = f"""'Security Alert' || chr(10) || chr(10) || 'Timestamp: ' || {STAMP} || chr(10) || 'User: ' || coalesce(username, 'Unknown') || chr(10)
  || 'IP Address: ' || coalesce(ip_address, 'Unknown') || chr(10) || 'Severity: ' || upper(severity) || chr(10) || 'Type: ' || anomaly_type || chr(10)
  || 'Details: ' || details"""
FIRED = {
    "ranked": """
  SELECT *, timestamp > TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AS inside,
    sum(CASE WHEN timestamp > TIMESTAMP '2024-01-31' - INTERVAL 30 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY severity ORDER BY alert_id) AS r FROM alerts_input""",
    "fired": """
  SELECT * FROM ranked WHERE CASE severity WHEN 'high' THEN inside AND r % 3 = 0 WHEN 'medium' THEN inside AND r % 5 = 0 ELSE true END""",
    "flagged": """
  SELECT a.*, coalesce(alert_id <= last, false) AS notified FROM alerts_input a
  LEFT JOIN (SELECT severity, max(alert_id) AS last FROM fired GROUP BY severity) USING (severity)""",
}
ORACLES["alerts"] = oracle(
    EV,
    DETECT,
    """SELECT event_id AS alert_id, timestamp, username, coalesce(ip_address, '') AS ip_address, severity, anomaly_type, details,
  CAST(0 AS BIGINT) AS notified, 'active' AS status FROM deduped""",
)
ORACLES["alerts_simple"] = oracle(
    EV,
    DETECT,
    """SELECT event_id AS alert_id, timestamp, username, coalesce(ip_address, 'Unknown') AS ip_address, severity, anomaly_type, details,
  CAST(0 AS BIGINT) AS notified, 'active' AS status FROM deduped""",
)
ORACLES["alert_message"] = oracle(AL, {}, f"SELECT alert_id, {MESSAGE} AS message FROM alerts_input")
ORACLES["alert_lines"] = oracle(
    AL,
    {},
    f"""SELECT alert_id, 'Alert triggered: ' || {MESSAGE} AS log_line, 'Alert triggered: ' || upper(severity) || ' SEVERITY: ' || details AS short_line,
  'ALERT: User ' || coalesce(username, 'None') || ' login from ' || coalesce(ip_address, 'None') || ' at ' || {STAMP} || ' — Risk: ' || upper(severity)
  || chr(10) || '       Reason: ' || details AS analyst_line FROM alerts_input""",
)
ORACLES["notification_text"] = oracle(AL, {}, f"SELECT alert_id, {SUBJECT} AS subject, {BODY} AS body FROM alerts_input")
ORACLES["notifications"] = oracle(AL, FIRED, "SELECT alert_id, severity, timestamp FROM fired")
ORACLES["moving_notifications"] = oracle(
    AL,
    {
        "RECURSIVE": "",
        "ranked": """
  SELECT alert_id, severity, epoch_us(timestamp) AS us, row_number() OVER (PARTITION BY severity ORDER BY timestamp, alert_id) AS rk,
    CASE severity WHEN 'high' THEN 3 WHEN 'medium' THEN 5 ELSE 1 END AS k
  FROM alerts_input""",
        "steps": """
  SELECT DISTINCT NULL::BIGINT AS alert_id, severity, 0::BIGINT AS rk, 0::BIGINT AS us, k, []::BIGINT[] AS seen FROM ranked
  UNION ALL
  SELECT r.alert_id, r.severity, r.rk, r.us, r.k,
    list_append(list_filter(CASE WHEN len(s.seen) >= s.k THEN [] ELSE s.seen END, lambda x: x > r.us - 3600000000), r.us)
  FROM steps s JOIN ranked r ON r.severity = s.severity AND r.rk = s.rk + 1""",
        "ends": "SELECT severity, max(rk) AS rk FROM steps GROUP BY severity",
        "waiting": """
  SELECT r.alert_id, r.severity FROM ends JOIN steps USING (severity, rk) JOIN ranked r
    ON r.severity = steps.severity AND r.rk > steps.rk - len(seen) AND len(seen) < steps.k""",
    },
    """SELECT alert_id, severity, k::BIGINT AS n FROM steps WHERE len(seen) >= k
UNION ALL SELECT alert_id, severity, NULL FROM waiting""",
)
ORACLES["notified_flags"] = oracle(AL, FIRED, "SELECT alert_id, severity, notified::INT::BIGINT AS notified FROM flagged")
ORACLES["recent_unnotified"] = oracle(
    AL,
    FIRED,
    """SELECT alert_id, timestamp, username, severity FROM flagged WHERE NOT notified AND timestamp > TIMESTAMP '2024-01-31' - INTERVAL 30 DAY
ORDER BY timestamp DESC""",
)
ORACLES["outbox"] = oracle(
    AL,
    FIRED,
    f"""SELECT alert_id, 'email' AS channel, {SUBJECT} AS subject, {BODY} AS body FROM fired
UNION ALL SELECT alert_id, 'log', NULL, 'Security Alert: ' || {MESSAGE} FROM fired""",
)
ORACLES["alert_status"] = oracle(AL, {}, "SELECT alert_id, severity, status FROM alerts_input")
ORACLES["alerts_by_severity"] = oracle(
    AL, {}, "SELECT * EXCLUDE (status) FROM alerts_input WHERE status = 'active' AND severity = 'high'"
)
ORACLES["alerts_by_user"] = oracle(
    AL, {}, "SELECT * EXCLUDE (status) FROM alerts_input WHERE status = 'active' AND username = 'user_7'"
)
ORACLES["active_alerts"] = oracle(AL, {}, "SELECT * FROM alerts_input WHERE status = 'active'")
ORACLES["alert_history"] = oracle(AL, {}, "SELECT * FROM alerts_input ORDER BY timestamp DESC, alert_id DESC LIMIT 100")
ORACLES["recent_alerts"] = oracle(
    AL,
    {},
    """SELECT alert_id, timestamp, username, ip_address, upper(severity) AS severity,
  CASE WHEN length(details) > 50 THEN substr(details, 1, 50) || '...' ELSE details END AS details
FROM alerts_input WHERE status = 'active' ORDER BY timestamp DESC, alert_id DESC LIMIT 10""",
)
ORACLES["alert_summary"] = oracle(
    AL,
    {"recent": "SELECT * FROM alerts_input WHERE timestamp > TIMESTAMP '2024-01-24'"},
    """SELECT 'severity' AS section, severity AS key, count(*) AS n FROM recent GROUP BY severity
UNION ALL SELECT * FROM (SELECT 'top_users', username, count(*) AS n FROM recent WHERE username <> '' GROUP BY username ORDER BY n DESC, username LIMIT 10)""",
)
ACTIVE = "FROM alerts_input WHERE status = 'active'"
ORACLES["summary_cards"] = oracle(
    AL,
    {},
    f"""SELECT count(*) AS total_alerts, count(*) FILTER (WHERE severity = 'high') AS high_severity, count(DISTINCT username) AS users_affected,
  count(DISTINCT anomaly_type) AS anomaly_types {ACTIVE}""",
)
ORACLES["alerts_per_day"] = oracle(AL, {}, f"SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, count(*) AS n {ACTIVE} GROUP BY 1")
ORACLES["severity_distribution"] = oracle(AL, {}, f"SELECT severity, count(*) AS n {ACTIVE} GROUP BY 1")
ORACLES["type_distribution"] = oracle(AL, {}, f"SELECT anomaly_type, count(*) AS n {ACTIVE} GROUP BY 1")
ORACLES["top_users"] = oracle(
    AL, {}, f"SELECT username, count(*) AS n {ACTIVE} AND username IS NOT NULL GROUP BY 1 ORDER BY n DESC, username LIMIT 10"
)
ORACLES["top3_ips_hours"] = oracle(
    EV,
    {
        "known": KNOWN,
        "vals": """
  SELECT username, 'ip' AS kind, ip_address AS value, count(*) AS n, 0 AS h FROM known WHERE ip_address IS NOT NULL GROUP BY ALL
  UNION ALL SELECT username, 'hour', CAST(hour(timestamp) AS VARCHAR), count(*), hour(timestamp) FROM known GROUP BY username, hour(timestamp)""",
    },
    """SELECT username, kind, value, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY username, kind ORDER BY n DESC, h, value) AS rank FROM vals) WHERE rank <= 3""",
)
ORACLES["first_anomalies"] = oracle(
    EV, DETECT, "SELECT event_id, username, anomaly_type, severity, details FROM deduped ORDER BY priority, event_id LIMIT 5"
)
ORACLES["run_summary"] = oracle(
    EV,
    DETECT,
    """SELECT 'events' AS section, 'entries' AS key, count(*) AS n FROM auth_events UNION ALL SELECT 'events', 'users', count(DISTINCT username) FROM auth_events
UNION ALL SELECT 'anomalies', severity, count(*) FROM deduped GROUP BY severity""",
)
ORACLES["severity_bands"] = """SELECT event_id, CASE WHEN -value / 100 < -0.5 THEN 'high' ELSE 'medium' END AS severity,
  CASE WHEN -value / 100 < -0.5 THEN 'high' WHEN -value / 100 < -0.2 THEN 'medium' ELSE 'low' END AS severity_three FROM events"""
ORACLES["risk_band"] = """SELECT event_id, CASE WHEN value / 100 > 0.7 THEN 'red' WHEN value / 100 > 0.4 THEN 'orange' ELSE 'green' END AS band,
  CASE WHEN value / 100 < 0.05 THEN 'red' WHEN value / 100 < 0.2 THEN 'orange' ELSE 'green' END AS colour FROM events"""

# --- graph -----------------------------------------------------------------------------------------------

GRAPH = {
    "RECURSIVE": "",
    "e": """
  SELECT DISTINCT 'u:' || username AS a, 'i:' || ip_address AS b FROM auth_events WHERE username IS NOT NULL AND ip_address IS NOT NULL
  UNION SELECT DISTINCT 'i:' || ip_address, 'u:' || username FROM auth_events WHERE username IS NOT NULL AND ip_address IS NOT NULL""",
    # walks of up to 8 steps; those of the shortest length between two nodes are the shortest paths
    "walks": """
  SELECT DISTINCT a AS s, a AS v, 0 AS d, CAST(1 AS DOUBLE) AS w FROM e
  UNION ALL SELECT s, b, d + 1, sum(w) FROM walks JOIN e ON v = a WHERE d < 8 GROUP BY s, b, d + 1""",
    "sp": "SELECT s, v, d, w FROM (SELECT *, min(d) OVER (PARTITION BY s, v) AS m FROM walks) WHERE d = m",
    "size": "SELECT count(DISTINCT a) AS n FROM e",
    "clo": """
  SELECT s AS node, ((count(*) - 1) / sum(d)) * ((count(*) - 1) / ((SELECT n FROM size) - 1)) AS closeness FROM sp GROUP BY s""",
    "through": """
  SELECT x.v AS node, sum(x.w * y.w / z.w) AS total FROM sp x JOIN sp y ON y.s = x.v JOIN sp z ON z.s = x.s AND z.v = y.v
  WHERE x.d + y.d = z.d AND x.d > 0 AND y.d > 0 GROUP BY x.v""",
    "bet": """
  SELECT node, coalesce(total, 0) / (((SELECT n FROM size) - 1) * ((SELECT n FROM size) - 2)) AS betweenness
  FROM (SELECT DISTINCT a AS node FROM e) LEFT JOIN through USING (node)""",
}
ORACLES["user_ip_edges"] = oracle(
    EV, {}, "SELECT username, ip_address, count(*) AS weight FROM auth_events WHERE username IS NOT NULL AND ip_address IS NOT NULL GROUP BY ALL"
)
ORACLES["node_degree"] = oracle(EV, {"e": GRAPH["e"]}, "SELECT a AS node, count(*) AS degree FROM e GROUP BY a")
ORACLES["closeness"] = oracle(EV, GRAPH, "SELECT node, round(closeness, 6) AS closeness FROM clo")
ORACLES["betweenness"] = oracle(EV, GRAPH, "SELECT node, round(betweenness, 6) AS betweenness FROM bet")
# an estimate within its bound of the value, for every node
ORACLES["betweenness_estimate"] = oracle(EV, GRAPH, "SELECT node, 1::BIGINT AS within FROM bet")
ORACLES["graph_anomalies"] = oracle(
    EV,
    GRAPH
    | {
        "vals": "SELECT node, closeness, betweenness FROM clo JOIN bet USING (node)",
        "st": """
  SELECT avg(betweenness) AS mb, stddev_pop(betweenness) AS sb, avg(closeness) AS mc, stddev_pop(closeness) AS sc FROM vals""",
        "zs": """
  SELECT substr(node, 3) AS name, CASE WHEN node LIKE 'u:%' THEN 'user' ELSE 'ip' END AS kind,
    CASE WHEN sb > 0 THEN (betweenness - mb) / sb ELSE 0 END AS bz, CASE WHEN sc > 0 THEN (closeness - mc) / sc ELSE 0 END AS cz FROM vals, st""",
    },
    """SELECT name AS node, kind AS node_type, round(bz, 6) AS betweenness_z, round(cz, 6) AS closeness_z, 'graph_structure' AS anomaly_type,
  CASE WHEN abs(bz) > 3 OR abs(cz) > 3 THEN 'high' ELSE 'medium' END AS severity,
  kind || ' "' || name || '" has unusual centrality (bet_z: ' || format('{:.2f}', bz) || ', clo_z: ' || format('{:.2f}', cz) || ')' AS details
FROM zs WHERE abs(bz) > 2 OR abs(cz) > 2""",
)
ORACLES["advanced_anomalies"] = oracle(
    EV,
    GRAPH
    | {
        "vals": "SELECT node, closeness, betweenness FROM clo JOIN bet USING (node)",
        "st": "SELECT avg(betweenness) AS mb, stddev_pop(betweenness) AS sb, avg(closeness) AS mc, stddev_pop(closeness) AS sc FROM vals",
        "zs": """
  SELECT substr(node, 3) AS username, CASE WHEN sb > 0 THEN (betweenness - mb) / sb ELSE 0 END AS bz,
    CASE WHEN sc > 0 THEN (closeness - mc) / sc ELSE 0 END AS cz FROM vals, st WHERE node LIKE 'u:%'""",
    }
    | SEQUENCE
    | {"firsts": "SELECT username, arg_min(event_id, us) AS event_id, min(timestamp) AS timestamp FROM known GROUP BY username"},
    """SELECT event_id, timestamp, username, 'Unknown' AS ip_address, NULL AS event_type, 'graph_structure' AS anomaly_type,
  CASE WHEN abs(bz) > 3 OR abs(cz) > 3 THEN 'high' ELSE 'medium' END AS severity,
  'user "' || username || '" has unusual centrality (bet_z: ' || format('{:.2f}', bz) || ', clo_z: ' || format('{:.2f}', cz) || ')' AS details,
  'graph_based' AS method FROM zs JOIN firsts USING (username) WHERE abs(bz) > 2 OR abs(cz) > 2
UNION ALL SELECT *, 'sequential_pattern' FROM seq""",
)
ORACLES["clustering"] = oracle(
    EV,
    {
        "seen": """
  SELECT username, lag(username) OVER (PARTITION BY ip_address ORDER BY timestamp, event_id) AS prev FROM auth_events
  WHERE username IS NOT NULL AND ip_address IS NOT NULL""",
        "half": "SELECT DISTINCT least(prev, username) AS a, greatest(prev, username) AS b FROM seen WHERE prev <> username",
        "e": "SELECT a, b FROM half UNION ALL SELECT b, a FROM half",
        "deg": "SELECT a, count(*) AS d FROM e GROUP BY a",
        "tri": "SELECT x.a, count(*) AS t FROM e x JOIN e y ON x.a = y.a AND x.b < y.b JOIN e z ON z.a = x.b AND z.b = y.b GROUP BY x.a",
    },
    """SELECT a AS node, round(CASE WHEN d > 1 THEN 2 * coalesce(t, 0) / (d * (d - 1)) ELSE 0 END, 6) AS clustering FROM deg LEFT JOIN tri USING (a)""",
)

# --- federated -------------------------------------------------------------------------------------------

CE = ["auth_events", "client_events"]
FED = ["hour", "day_of_week", "day_of_month", "month", "username_hash", "ip_hash", "is_private_ip", "event_type_encoded", "hour_username_interaction"]
FED_ROWS = {
    "feats": f"""
  SELECT event_id, client_id, label, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
    {md5_bucket("coalesce(username, 'None')")} AS username_hash, {md5_bucket("coalesce(ip_address, 'None')")} AS ip_hash, {PRIVATE} AS is_private_ip,
    {CODE3} AS event_type_encoded, hour(timestamp) * ({md5_bucket("coalesce(username, 'None')")}) AS hour_username_interaction FROM client_events""",
    "cstats": "SELECT client_id, count(*) AS n, " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FED) + " FROM feats GROUP BY client_id",
    "x": "SELECT event_id, client_id, n, label, "
    + ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}" for c in FED)
    + " FROM feats JOIN cstats USING (client_id)",
}


def gradient_sql(weights: list[float]) -> dict[str, str]:
    z = " + ".join(f"({weights[i]!r}) * {c}" for i, c in enumerate(FED)) + f" + ({weights[-1]!r})"
    sums = ", ".join(f"sum(miss * {c}) AS {c}" for c in FED)
    return {
        "misses": f"SELECT *, 1 / (1 + exp(-({z}))) - label AS miss FROM x",
        "gsum": f"SELECT client_id, n, {sums}, sum(miss) AS intercept FROM misses GROUP BY client_id, n",
        "grads": f"SELECT client_id, n, param, grad FROM (UNPIVOT gsum ON {', '.join(FED)}, intercept INTO NAME param VALUE grad)",
    }


STEP = FED_ROWS | gradient_sql([0.0] * 10) | {
    "params": "SELECT client_id, n, param, -0.5 * grad / n AS value FROM grads",
    "model": "SELECT param, sum(n * value) / sum(n) AS value FROM params GROUP BY param",
}
CLIENT_N = "SELECT client_id, count(*) AS n FROM client_events GROUP BY client_id"
DRAWN = """
  SELECT round, client_id, n FROM (SELECT round, client_id, n, row_number() OVER (PARTITION BY round ORDER BY md5('42-' || round || '-' || client_id), client_id) AS r
    FROM sizes, (SELECT unnest(range(1, 6)) AS round)) WHERE r <= 2"""

ORACLES["fed_weighted_mean"] = oracle(
    ["client_vectors"], {}, "SELECT idx, round(sum(weight * grad) / sum(weight), 6) AS grad FROM client_vectors GROUP BY idx"
)
ORACLES["fed_gradient"] = oracle(
    CE, FED_ROWS | gradient_sql([0.1 * (i - 4) for i in range(10)]), "SELECT client_id, n, param, round(grad, 4) AS grad FROM grads"
)
ORACLES["fed_average"] = oracle(CE, STEP, "SELECT param, round(value, 6) AS value FROM model")
ORACLES["param_encryption"] = oracle(CE, STEP, "SELECT client_id, param, round(value, 6) AS value FROM params")
ORACLES["fed_forest_params"] = oracle(
    CE,
    {
        "configs": """
  SELECT client_id, avg(CASE WHEN event_type = 'failed_login' THEN 1.0 ELSE 0 END) AS contamination, 100 + count(*) % 7 AS n_estimators,
    least(256, count(*)) AS max_samples, count(username) % 100 AS random_state FROM client_events GROUP BY client_id"""
    },
    """SELECT round(avg(contamination), 6) AS contamination, CAST(floor(avg(n_estimators)) AS BIGINT) AS n_estimators,
  arg_min(max_samples, client_id) AS max_samples, arg_min(random_state, client_id) AS random_state FROM configs""",
)
ORACLES["fed_status"] = oracle(
    CE,
    {"sizes": CLIENT_N, "drawn": DRAWN},
    """SELECT 'total_clients' AS section, 'all' AS key, CAST(count(*) AS DOUBLE) AS value FROM sizes
UNION ALL SELECT 'average_data_size', 'all', round(avg(n), 6) FROM sizes UNION ALL SELECT 'completed_rounds', 'all', count(DISTINCT round) FROM drawn
UNION ALL SELECT 'participants', CAST(round AS VARCHAR), count(*) FROM drawn GROUP BY round
UNION ALL SELECT 'participation', s.client_id, count(d.round) FROM sizes s LEFT JOIN drawn d USING (client_id) GROUP BY s.client_id""",
)
ORACLES["fed_metrics"] = oracle(
    CE,
    STEP
    | {
        "flat": "SELECT " + ", ".join(f"max(value) FILTER (WHERE param = '{c}') AS w_{c}" for c in [*FED, "intercept"]) + " FROM model",
        "guess": "SELECT label, CASE WHEN " + " + ".join(f"w_{c} * {c}" for c in FED) + " + w_intercept > 0 THEN 1 ELSE 0 END AS p FROM x, flat",
        "per": """
  SELECT c, (SELECT count(*) FROM guess WHERE label = c) AS support, (SELECT count(*) FROM guess WHERE p = c) AS guessed,
    (SELECT count(*) FROM guess WHERE p = c AND label = c) AS hits, (SELECT count(*) FROM guess) AS total FROM (SELECT DISTINCT label AS c FROM guess)""",
    },
    """SELECT round(sum(hits) / max(total), 6) AS accuracy, round(sum(support * CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END / total), 6) AS precision,
  round(sum(hits / total), 6) AS recall FROM per""",
)

# --- windows ---------------------------------------------------------------------------------------------


def windows_cte(days: bool = False) -> str:
    """Each event once per window it falls into: 5 minutes every minute, or 3 days every day."""
    unit, n = ("day", 3) if days else ("minute", 5)
    return f"""
  SELECT *, date_trunc('{unit}', timestamp)::TIMESTAMP - k * INTERVAL 1 {unit} AS window_start FROM auth_events, (SELECT unnest(range(0, {n})) AS k)"""


METRICS = {
    "win": windows_cte(),
    "metrics": """
  SELECT window_start, count(*) AS total_events, count(DISTINCT username) AS unique_users, count(DISTINCT ip_address) AS unique_ips,
    count(*) FILTER (WHERE event_type = 'successful_login') AS successful_logins, count(*) FILTER (WHERE event_type = 'failed_login') AS failed_logins,
    count(*) / 5.0 AS login_rate_per_minute FROM win GROUP BY window_start""",
}
ORACLES["sliding_window_counts"] = oracle(EV, METRICS, "SELECT window_start, total_events FROM metrics")
ORACLES["window_metrics"] = oracle(
    EV, METRICS, "SELECT * REPLACE (CAST(login_rate_per_minute AS DOUBLE) AS login_rate_per_minute) FROM metrics"
)
ORACLES["window_user_metrics"] = oracle(
    EV,
    {"win": windows_cte()},
    """SELECT window_start, username, count(*) AS login_count, round(avg(CASE WHEN event_type = 'successful_login' THEN 1.0 ELSE 0 END), 6) AS success_rate,
  count(DISTINCT ip_address) AS unique_ips, round(avg(hour(timestamp)), 6) AS avg_hour FROM win WHERE username IS NOT NULL GROUP BY window_start, username""",
)
HABITS = {
    "first": "SELECT * FROM (SELECT * FROM auth_events ORDER BY timestamp, event_id LIMIT 1000) WHERE username IS NOT NULL",
    "freq": "SELECT username, count(*) / 5000 AS avg_login_frequency FROM first GROUP BY username",
    "fips": """
  SELECT username, string_agg(ip_address, ' | ' ORDER BY r) AS common_ips, count(*) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY username ORDER BY n DESC, ip_address) AS r FROM (
      SELECT username, ip_address, count(*) AS n FROM first WHERE ip_address IS NOT NULL GROUP BY ALL)) WHERE r <= 3 GROUP BY username""",
    "fhours": """
  SELECT username, string_agg(h, ' | ' ORDER BY r) AS preferred_times FROM (
    SELECT *, row_number() OVER (PARTITION BY username ORDER BY n DESC, h) AS r FROM (
      SELECT username, hour(timestamp) AS h, count(*) AS n FROM first GROUP BY ALL)) WHERE r <= 3 GROUP BY username""",
}
ORACLES["stream_baseline"] = oracle(
    EV,
    HABITS,
    """SELECT username, round(avg_login_frequency, 6) AS avg_login_frequency, coalesce(common_ips, '') AS common_ips, preferred_times
FROM freq LEFT JOIN fips USING (username) LEFT JOIN fhours USING (username)""",
)
ORACLES["volume_spike"] = oracle(
    EV,
    METRICS | {"base": "SELECT count(*) / ((max(epoch_us(timestamp)) - min(epoch_us(timestamp))) / 60e6) AS rate FROM auth_events"},
    """SELECT window_start, 'volume_spike' AS anomaly_type, 'high' AS severity, CAST(login_rate_per_minute AS DOUBLE) AS metric_value, round(rate, 6) AS baseline_value,
  'Login rate spike: ' || format('{:.2f}', CAST(login_rate_per_minute AS DOUBLE)) || ' vs baseline ' || format('{:.2f}', rate) || ' per minute' AS details
FROM metrics, base WHERE login_rate_per_minute > 3 * rate""",
)
ORACLES["stream_unusual_ip"] = oracle(
    EV,
    HABITS
    | {
        "win": windows_cte(days=True),
        "um": "SELECT window_start, username, count(DISTINCT ip_address) AS unique_ips FROM win WHERE username IS NOT NULL GROUP BY ALL",
        "hab": "SELECT username, coalesce(n, 0) AS k FROM freq LEFT JOIN fips USING (username)",
    },
    """SELECT window_start, username, unique_ips, (unique_ips > 2 * k)::INT::BIGINT AS is_unusual,
  'User ' || username || ' logging in from ' || unique_ips || ' IPs vs baseline of ' || k AS details FROM um JOIN hab USING (username)""",
)
ORACLES["streamed_windows"] = oracle(
    EV,
    METRICS,
    """SELECT * REPLACE (CAST(login_rate_per_minute AS DOUBLE) AS login_rate_per_minute) FROM metrics
WHERE window_start + INTERVAL 5 MINUTE <= date_trunc('millisecond', (SELECT max(timestamp) FROM auth_events))::TIMESTAMP - INTERVAL 1 MINUTE""",
)
ORACLES["streamed_user_windows"] = oracle(
    EV,
    {"win": windows_cte(days=True)},
    """SELECT window_start, username, count(*) AS login_count, round(avg(CASE WHEN event_type = 'successful_login' THEN 1.0 ELSE 0 END), 6) AS success_rate,
  count(DISTINCT ip_address) AS unique_ips, round(avg(hour(timestamp)), 6) AS avg_hour FROM win WHERE username IS NOT NULL
  AND window_start + INTERVAL 3 DAY <= date_trunc('millisecond', (SELECT max(timestamp) FROM auth_events WHERE username IS NOT NULL))::TIMESTAMP - INTERVAL 7 DAY
GROUP BY window_start, username""",
)
# a session is told once the watermark has passed the day of its logout
ORACLES["streamed_sessions"] = oracle(
    EV,
    {"known": KNOWN, "sess": sessions_cte("known")},
    """SELECT event_id, username, round(hours, 6) AS session_hours FROM sess
WHERE date_trunc('day', timestamp + to_microseconds(CAST(round(hours * 3600000000) AS BIGINT))) + INTERVAL 1 DAY <= (
  SELECT date_trunc('millisecond', max(timestamp)) - INTERVAL 7 DAY FROM known WHERE event_type IN ('successful_login', 'logout'))""",
)
