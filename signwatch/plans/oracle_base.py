"""DuckDB text of the derived tables, shared by the oracle queries."""

from __future__ import annotations

ADAPTERS = {
    "auth_events": """
  SELECT event_id, ts AS timestamp, 'host1' AS hostname, 'sshd' AS service,
    CASE event_type WHEN 'error' THEN 'failed_login' WHEN 'signup' THEN 'logout' WHEN 'view' THEN 'access' ELSE 'successful_login' END AS event_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'user_' || user_id END AS username,
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN k < 10 THEN '203.0.113.' || (k % 4)
         ELSE '10.0.0.' || (k % 8) END AS ip_address,
    'event ' || event_id AS message
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "syslog_lines": """
  SELECT event_id, strftime(timestamp, '%b %d %H:%M:%S') || ' host1 sshd[' || event_id || ']: ' ||
    CASE event_type WHEN 'failed_login' THEN 'Failed password for ' WHEN 'logout' THEN 'Disconnected from user '
      WHEN 'access' THEN 'Received signal for ' ELSE 'Accepted password for ' END ||
    coalesce(username, 'invalid user x') || ' from ' || coalesce(ip_address, 'nowhere') || ' port 22 ssh2' AS line
  FROM auth_events""",
    "json_lines": """
  SELECT event_id, '{"timestamp": "' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '", "username": "' || coalesce(username, '') ||
    '", "ip_address": "' || coalesce(ip_address, '') || '", "event_type": "' || event_type || '"}' AS line
  FROM auth_events""",
    "csv_lines": """
  SELECT event_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') || ',' || coalesce(username, '') || ',' || coalesce(ip_address, '')
    || ',' || event_type || ',' || message AS line
  FROM auth_events""",
    "apache_lines": """
  SELECT event_id, coalesce(ip_address, '-') || ' - ' || coalesce(username, '-') || ' [' || strftime(timestamp, '%d/%b/%Y:%H:%M:%S') ||
    ' +0000] "GET /login HTTP/1.1" ' || CASE event_type WHEN 'failed_login' THEN '401' WHEN 'logout' THEN '302' ELSE '200' END
    || ' 512 "-" "agent"' AS line
  FROM auth_events""",
    "mixed_lines": """
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN s.line WHEN 1 THEN j.line WHEN 2 THEN c.line WHEN 3 THEN a.line
    ELSE 'garbage ' || event_id END AS line
  FROM syslog_lines s JOIN json_lines j USING (event_id) JOIN csv_lines c USING (event_id) JOIN apache_lines a USING (event_id)""",
    "keystrokes": """
  SELECT event_id, 'user_' || user_id AS username, user_id || '-' || (day(ts) // 10) AS session_id, ts AS timestamp,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'down' ELSE 'up' END AS keystroke_type,
    CAST(CAST(json_extract_string(props, '$.k') AS INT) % 4 AS VARCHAR) AS key
  FROM events""",
    "mouse_events": """
  SELECT event_id, 'user_' || user_id AS username, user_id || '-' || (day(ts) // 10) AS session_id, ts AS timestamp,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS x, CAST(floor(value) AS BIGINT) AS y,
    CASE event_type WHEN 'click' THEN 'click' ELSE 'move' END AS event_type
  FROM events""",
    "client_events": """
  SELECT a.*, 'client_' || (e.user_id % 3) AS client_id, CAST(CASE WHEN e.value > 50 THEN 1 ELSE 0 END AS BIGINT) AS label
  FROM auth_events a JOIN events e USING (event_id)""",
    "client_vectors": """
  SELECT vec_id AS client_id, CAST(1 + vec_id % 5 AS BIGINT) AS weight, CAST(i - 1 AS BIGINT) AS idx, CAST(embedding[i] AS DOUBLE) AS grad
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "alerts_input": """
  SELECT event_id AS alert_id, timestamp, username, ip_address,
    CASE event_type WHEN 'failed_login' THEN 'high' WHEN 'logout' THEN 'medium' ELSE 'low' END AS severity,
    CASE event_id % 3 WHEN 0 THEN 'unusual_time' WHEN 1 THEN 'location_change' ELSE 'high_frequency' END AS anomaly_type,
    'alert raised for ' || coalesce(username, 'Unknown') || ' while signing in from address ' || coalesce(ip_address, 'Unknown') AS details,
    CASE event_id % 10 WHEN 0 THEN 'acknowledged' WHEN 1 THEN 'cleared' ELSE 'active' END AS status
  FROM auth_events WHERE event_type <> 'successful_login'""",
}

LINES = ["syslog_lines", "json_lines", "csv_lines", "apache_lines", "mixed_lines"]


def oracle(tables: list[str], ctes: dict[str, str], body: str) -> str:
    """``WITH`` the named derived tables and further CTEs, then the body."""
    parts = {name: ADAPTERS[name] for name in tables} | ctes
    head = "WITH RECURSIVE " if "RECURSIVE" in ctes else "WITH "
    parts.pop("RECURSIVE", None)
    return head + ",\n".join(f"{name} AS ({text}\n)" for name, text in parts.items()) + "\n" + body
