"""Registered queries: each applies one operator to whole tables and names its output columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.functions import scalars
from signwatch.lineage import scratch
from signwatch.operators import alerts as alerting
from signwatch.operators import biometrics, detectors, explain, features, federated, forest, graph, profiles
from signwatch.operators import reports
from signwatch.plans import fixtures as fx
from signwatch.plans import runs
from signwatch.sources import logs
from signwatch.streaming import stateful, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    """Doubles to 6 places, so that both engines print them alike."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), places) + F.lit(0.0) for n in names})


# --- detectors -------------------------------------------------------------------------------------------


@query
def high_frequency(spark, sf):
    return detectors.high_frequency(fx.auth_events(spark, sf))


@query
def logins_24h(spark, sf):
    return detectors.logins_in_window(fx.auth_events(spark, sf))


@query
def typical_hour(spark, sf):
    return detectors.typical_hour(fx.auth_events(spark, sf))


@query
def unusual_time(spark, sf):
    return detectors.unusual_time(fx.auth_events(spark, sf))


@query
def unusual_time_simple(spark, sf):
    return detectors.unusual_time_simple(fx.auth_events(spark, sf))


@query
def location_change(spark, sf):
    return detectors.location_change(fx.auth_events(spark, sf))


@query
def unusual_location(spark, sf):
    return detectors.unusual_location(fx.auth_events(spark, sf))


@query
def new_ip_flag(spark, sf):
    return detectors.new_ip_flag(fx.auth_events(spark, sf))


@query
def brute_force(spark, sf):
    return detectors.brute_force(fx.auth_events(spark, sf), seconds=86400)


@query
def sequential_timing(spark, sf):
    return detectors.sequential_timing(fx.auth_events(spark, sf))


@query
def time_since_last(spark, sf):
    rows = detectors.time_since_last(fx.auth_events(spark, sf))
    return rounded(rows.select("event_id", "username", "timestamp", "hours_since_last"), "hours_since_last")


@query
def all_anomalies(spark, sf):
    return detectors.statistical(fx.auth_events(spark, sf))


@query
def dedup_anomalies(spark, sf):
    return detectors.dedup(detectors.statistical(fx.auth_events(spark, sf)))


@query
def detect_anomalies(spark, sf):
    return detectors.detect(fx.auth_events(spark, sf)).drop("priority")


@query
def dedup_simple(spark, sf):
    return detectors.dedup_simple(detectors.statistical_simple(fx.auth_events(spark, sf), seconds=86400))


# --- reports ---------------------------------------------------------------------------------------------


@query
def anomaly_report(spark, sf):
    return reports.anomaly_report(detectors.detect(fx.auth_events(spark, sf)))


# --- sources ---------------------------------------------------------------------------------------------

YEAR = 2024


def parsed_columns(parsed: DataFrame) -> DataFrame:
    columns = ["event_id", "detected_format", *logs.FIELDS]
    return logs.accepted(parsed).select(*columns)


@query
def parse_syslog(spark, sf):
    return parsed_columns(logs.parse(fx.log_lines(spark, sf, "syslog"), "syslog", YEAR))


@query
def parse_json(spark, sf):
    return parsed_columns(logs.parse(fx.log_lines(spark, sf, "json"), "json"))


@query
def parse_csv(spark, sf):
    return parsed_columns(logs.parse(fx.log_lines(spark, sf, "csv"), "csv"))


@query
def parse_apache(spark, sf):
    return parsed_columns(logs.parse(fx.log_lines(spark, sf, "apache"), "apache_combined"))


@query
def parse_auto(spark, sf):
    return parsed_columns(logs.parse(fx.mixed_lines(spark, sf), "auto", YEAR))


@query
def quarantine(spark, sf):
    return logs.quarantine(logs.parse(fx.mixed_lines(spark, sf), "auto", YEAR))


@query
def multi_source_union(spark, sf):
    """The same events arriving through four sources, told apart by the detected format."""
    sources = [fx.log_lines(spark, sf, fmt) for fmt in ("syslog", "json", "csv", "apache")]
    lines = sources[0].union(sources[1]).union(sources[2]).union(sources[3])
    return parsed_columns(logs.parse(lines, "auto", YEAR)).drop("hostname", "service", "message")


@query
def strict_ingest(spark, sf):
    return logs.strict(logs.parse(fx.log_lines(spark, sf, "syslog"), "auto", YEAR)).select("event_id", *logs.FIELDS)


@query
def event_class_counts(spark, sf):
    events = parsed_columns(logs.parse(fx.log_lines(spark, sf, "syslog"), "syslog", YEAR))
    return reports.count_by(events, "event_type", "event_type")


# --- features --------------------------------------------------------------------------------------------


@query
def calendar_features(spark, sf):
    return fx.auth_events(spark, sf).select("event_id", *[c.alias(n) for n, c in scalars.calendar().items()])


@query
def event_code(spark, sf):
    return fx.auth_events(spark, sf).select(
        "event_id",
        scalars.event_code().alias("event_code"),
        scalars.event_code(with_access=False).alias("event_code_client"),
    )


@query
def hash_bucket(spark, sf):
    return fx.auth_events(spark, sf).select(
        "event_id",
        scalars.hash_bucket("ip_address").alias("ip_hash"),
        scalars.hash_bucket("username", "None").alias("username_hash"),
    )


@query
def private_ip(spark, sf):
    return fx.auth_events(spark, sf).select(
        "event_id",
        scalars.is_private_ip().alias("is_private_ip"),
        scalars.is_private_ip(rfc1918=True).alias("is_rfc1918"),
    )


@query
def label_encode(spark, sf):
    rows = features.encode(fx.auth_events(spark, sf), "username", "username_encoded")
    return rows.select("event_id", "username", "username_encoded")


@query
def interaction(spark, sf):
    return features.ml_features(fx.auth_events(spark, sf)).select("event_id", "hour_username_interaction")


@query
def ml_features(spark, sf):
    return features.ml_features(fx.auth_events(spark, sf))


@query
def ml_features_simple(spark, sf):
    return features.ml_features_simple(fx.auth_events(spark, sf))


@query
def scaled_features(spark, sf):
    rows = features.scaled(features.ml_features(fx.auth_events(spark, sf)), features.ML_COLUMNS)
    return rounded(rows, *features.ML_COLUMNS)


@query
def fed_features(spark, sf):
    return features.client_features(fx.client_events(spark, sf), "client_id")


@query
def xai_features(spark, sf):
    return rounded(features.explanation_features(fx.auth_events(spark, sf)), "hours_since_last", "active_days")


# --- profiles --------------------------------------------------------------------------------------------

CUTOFF = "2024-01-16 00:00:00"


def history(spark, sf):
    return fx.auth_events(spark, sf).where(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp_ntz"))


def recent(spark, sf):
    return fx.auth_events(spark, sf).where(F.col("timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz"))


@query
def session_durations(spark, sf):
    return rounded(profiles.session_durations(fx.auth_events(spark, sf)), "session_hours")


PROFILE_NUMBERS = ["login_hour_avg", "session_hours_avg", "login_frequency_per_day", "success_rate"]


@query
def user_profiles(spark, sf):
    return rounded(profiles.user_profiles(fx.auth_events(spark, sf)), *PROFILE_NUMBERS)


@query
def user_locations(spark, sf):
    rows = profiles.locations(fx.auth_events(spark, sf))
    return rows.select("username", "ip_address", "n", F.timestamp_micros("first_us").alias("first_seen"))


@query
def profile_merge(spark, sf):
    """Profiles of two half months, merged from their sums."""
    old, new = history(spark, sf), recent(spark, sf)
    state = profiles.merge_states(profiles.profile_state(old), profiles.profile_state(new))
    known = profiles.merge_locations(profiles.locations(old), profiles.locations(new))
    return rounded(profiles.summary(state, known), *PROFILE_NUMBERS)


@query
def user_profiles_simple(spark, sf):
    rows = profiles.user_profiles_simple(fx.auth_events(spark, sf), fx.AS_OF).drop("day_mask")
    return rounded(rows, "login_hour_avg", "login_frequency_per_day", "success_rate")


@query
def failed_times(spark, sf):
    return profiles.failed_times(fx.auth_events(spark, sf))


@query
def similarity(spark, sf):
    old = history(spark, sf)
    rows = profiles.similarity(recent(spark, sf), profiles.profile_state(old), profiles.locations(old))
    return rounded(rows, "similarity")


@query
def behavior_change(spark, sf):
    rows = profiles.behavior_change(fx.auth_events(spark, sf), CUTOFF, fx.AS_OF)
    return rounded(rows.drop("description"), "baseline_mean", "recent_mean", "z_score")


@query
def login_check(spark, sf):
    old = history(spark, sf)
    return profiles.login_check(
        recent(spark, sf), profiles.user_profiles_simple(old, CUTOFF), profiles.locations(old)
    )


# --- biometrics ------------------------------------------------------------------------------------------


def whole(df: DataFrame, *names: str) -> DataFrame:
    """Booleans as 0 / 1."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# habits are learned before this day, sessions are scored from it on
HABITS_UNTIL = "2024-01-20"


def before_cutoff(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp") < F.lit(HABITS_UNTIL).cast("timestamp_ntz"))


def from_cutoff(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp") >= F.lit(HABITS_UNTIL).cast("timestamp_ntz"))


@query
def key_hold_times(spark, sf):
    return rounded(biometrics.hold_times(fx.keystrokes(spark, sf)), "hold")


@query
def key_flight_latency(spark, sf):
    return rounded(biometrics.flight_latency(fx.keystrokes(spark, sf)), "seconds")


@query
def typing_speed(spark, sf):
    return rounded(biometrics.typing_speed(fx.keystrokes(spark, sf)), "speed")


def rounded_profile(rows: DataFrame) -> DataFrame:
    """Means of whole microseconds are often exact ties at 6 places, so times are rounded to 3."""
    times = [c for c in rows.columns if c.startswith(("hold_", "flight_", "latency_", "click_"))]
    rest = [c for c in rows.columns if c.endswith(("_mean", "_std")) and c not in times]
    return rounded(rounded(rows, *times, places=3), *rest)


@query
def keystroke_profile(spark, sf):
    return rounded_profile(biometrics.keystroke_profile(biometrics.keystroke_samples(fx.keystrokes(spark, sf))))


def keystroke_scores(spark, sf):
    keys = fx.keystrokes(spark, sf)
    profile = biometrics.keystroke_profile(biometrics.keystroke_samples(before_cutoff(keys)))
    return biometrics.keystroke_anomaly(biometrics.keystroke_samples(from_cutoff(keys)), profile)


@query
def keystroke_anomaly(spark, sf):
    return whole(rounded(keystroke_scores(spark, sf), "confidence", "anomaly_score"), "is_anomaly")


@query
def mouse_speed(spark, sf):
    rows = biometrics.mouse_moves(fx.mouse_events(spark, sf)).where(F.col("speed").isNotNull())
    return rounded(rows.select("event_id", "username", "session_id", "speed", "acceleration"), "speed", "acceleration")


@query
def mouse_turns(spark, sf):
    rows = biometrics.mouse_moves(fx.mouse_events(spark, sf)).where(F.col("turn").isNotNull())
    return rounded(rows.select("event_id", "username", "session_id", "turn"), "turn")


@query
def click_intervals(spark, sf):
    return rounded(biometrics.click_intervals(fx.mouse_events(spark, sf)), "interval")


@query
def path_efficiency(spark, sf):
    return rounded(biometrics.path_efficiency(biometrics.mouse_moves(fx.mouse_events(spark, sf))), "efficiency")


@query
def mouse_profile(spark, sf):
    return rounded_profile(biometrics.mouse_profile(biometrics.mouse_samples(fx.mouse_events(spark, sf))))


def mouse_scores(spark, sf):
    mouse = fx.mouse_events(spark, sf)
    profile = biometrics.mouse_profile(biometrics.mouse_samples(before_cutoff(mouse)))
    return biometrics.mouse_anomaly(biometrics.mouse_samples(from_cutoff(mouse)), profile)


@query
def mouse_anomaly(spark, sf):
    return whole(rounded(mouse_scores(spark, sf), "confidence", "anomaly_score"), "is_anomaly")


@query
def biometric_session(spark, sf):
    rows = biometrics.session_verdict(keystroke_scores(spark, sf), mouse_scores(spark, sf))
    return whole(rounded(rows, "confidence"), "overall_anomaly")


# --- explanations ----------------------------------------------------------------------------------------


def joined_texts(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.array_join(n, " | ") for n in names})


@query
def explain_match(spark, sf):
    events = fx.auth_events(spark, sf)
    return explain.match_records(detectors.detect(events), events).drop("priority")


@query
def explain_rules(spark, sf):
    old = history(spark, sf)
    rows = explain.rules(recent(spark, sf), profiles.profile_state(old), profiles.locations(old))
    return joined_texts(rows.select("event_id", "username", "rule_based"), "rule_based")


@query
def value_rarity(spark, sf):
    return rounded(explain.value_rarity(fx.auth_events(spark, sf)), "share")


@query
def explain_rarity(spark, sf):
    events = fx.auth_events(spark, sf)
    return joined_texts(explain.rarity(events, events).select("event_id", "rarity"), "rarity")


def report(spark, sf):
    events, old = fx.auth_events(spark, sf), history(spark, sf)
    return explain.explained_report(
        detectors.detect(events), events, profiles.profile_state(old), profiles.locations(old)
    )


@query
def explained_report(spark, sf):
    columns = ["event_id", "record_id", "anomaly_type", "severity", "rule_based", "rarity"]
    return joined_texts(report(spark, sf).select(*columns), "rule_based", "rarity")


@query
def explanation_summary(spark, sf):
    return explain.explanation_summary(report(spark, sf))


# --- alerts ----------------------------------------------------------------------------------------------

MONTH_MINUTES = 30 * 24 * 60


@query
def alerts(spark, sf):
    return whole(alerting.from_anomalies(detectors.detect(fx.auth_events(spark, sf))), "notified")


@query
def alerts_simple(spark, sf):
    return whole(alerting.from_anomalies_simple(detectors.detect(fx.auth_events(spark, sf))), "notified")


@query
def alert_message(spark, sf):
    return fx.alerts_input(spark, sf).select("alert_id", alerting.message().alias("message"))


@query
def alert_lines(spark, sf):
    return fx.alerts_input(spark, sf).select(
        "alert_id",
        alerting.log_line().alias("log_line"),
        alerting.log_line_simple().alias("short_line"),
        alerting.analyst_line().alias("analyst_line"),
    )


@query
def notification_text(spark, sf):
    return fx.alerts_input(spark, sf).select(
        "alert_id", alerting.subject().alias("subject"), alerting.body().alias("body")
    )


@query
def notifications(spark, sf):
    rows = alerting.notifications(fx.alerts_input(spark, sf), fx.AS_OF, MONTH_MINUTES)
    return rows.select("alert_id", "severity", "timestamp")


@query
def moving_notifications(spark, sf):
    rows = alerting.moving_notifications(fx.alerts_input(spark, sf), 60)
    return rows.select("alert_id", "severity", "n")


@query
def notified_flags(spark, sf):
    rows = alerting.notified_flags(fx.alerts_input(spark, sf), fx.AS_OF, MONTH_MINUTES)
    return whole(rows.select("alert_id", "severity", "notified"), "notified")


@query
def recent_unnotified(spark, sf):
    flagged = alerting.notified_flags(fx.alerts_input(spark, sf), fx.AS_OF, MONTH_MINUTES)
    rows = alerting.recent_unnotified(flagged, fx.AS_OF, MONTH_MINUTES)
    return rows.select("alert_id", "timestamp", "username", "severity")


@query
def outbox(spark, sf):
    return alerting.outbox(alerting.notifications(fx.alerts_input(spark, sf), fx.AS_OF, MONTH_MINUTES))


@query
def alert_status(spark, sf):
    """Alerts acknowledged an hour and cleared two hours after they were raised."""
    rows = fx.alerts_input(spark, sf)
    touched, gone = rows.where("status <> 'active'"), rows.where("status = 'cleared'")
    changes = alerting.change_status(touched, "acknowledged", F.expr("timestamp + INTERVAL 1 HOUR")).unionByName(
        alerting.change_status(gone, "cleared", F.expr("timestamp + INTERVAL 2 HOURS"))
    )
    current = alerting.current_status(rows, changes)
    return current.select("alert_id", "severity", "status")


@query
def alerts_by_severity(spark, sf):
    return alerting.active(fx.alerts_input(spark, sf)).where("severity = 'high'").drop("status")


@query
def alerts_by_user(spark, sf):
    return alerting.active(fx.alerts_input(spark, sf)).where("username = 'user_7'").drop("status")


@query
def active_alerts(spark, sf):
    return alerting.active(fx.alerts_input(spark, sf))


@query
def alert_history(spark, sf):
    return alerting.newest(fx.alerts_input(spark, sf), 100)


@query
def recent_alerts(spark, sf):
    return alerting.recent_table(fx.alerts_input(spark, sf))


@query
def alert_summary(spark, sf):
    since = F.expr(f"TIMESTAMP_NTZ'{fx.AS_OF}' - INTERVAL 7 DAYS")
    return reports.alert_summary(fx.alerts_input(spark, sf), since)


@query
def summary_cards(spark, sf):
    return reports.summary_cards(alerting.active(fx.alerts_input(spark, sf)))


@query
def alerts_per_day(spark, sf):
    return reports.alerts_per_day(alerting.active(fx.alerts_input(spark, sf)))


@query
def severity_distribution(spark, sf):
    return reports.count_by(alerting.active(fx.alerts_input(spark, sf)), "severity", "severity")


@query
def type_distribution(spark, sf):
    return reports.count_by(alerting.active(fx.alerts_input(spark, sf)), "anomaly_type", "anomaly_type")


@query
def top_users(spark, sf):
    return reports.top(alerting.active(fx.alerts_input(spark, sf)).where("username IS NOT NULL"), "username")


@query
def top3_ips_hours(spark, sf):
    """The three most frequent addresses and hours of each user."""
    events = fx.auth_events(spark, sf).where("username IS NOT NULL").withColumn("hour", scalars.hour())
    ips = detectors.top_values(events, ["username"], "ip_address", 3).withColumnRenamed("ip_address", "value")
    hours = detectors.top_values(events, ["username"], "hour", 3).withColumn("hour", F.col("hour").cast("string"))
    both = ips.withColumn("kind", F.lit("ip")).unionByName(
        hours.withColumnRenamed("hour", "value").withColumn("kind", F.lit("hour"))
    )
    return both.withColumn("rank", F.col("rank").cast("bigint"))


@query
def first_anomalies(spark, sf):
    rows = detectors.detect(fx.auth_events(spark, sf)).orderBy("priority", "event_id").limit(5)
    return rows.select("event_id", "username", "anomaly_type", "severity", "details")


@query
def run_summary(spark, sf):
    events = fx.auth_events(spark, sf)
    return reports.run_summary(events, detectors.detect(events))


@query
def severity_bands(spark, sf):
    """Bands of a score taken from the event value, falling from 0."""
    rows = fx.load(spark, sf, "events").select("event_id", (-F.col("value") / 100).alias("score"))
    return rows.select(
        "event_id",
        scalars.score_severity("score").alias("severity"),
        scalars.score_severity_three("score").alias("severity_three"),
    )


@query
def risk_band(spark, sf):
    rows = fx.load(spark, sf, "events").select("event_id", (F.col("value") / 100).alias("risk"))
    return rows.withColumn("severity", scalars.score_severity_three("risk", 0.05, 0.2)).select(
        "event_id", scalars.risk_band("risk").alias("band"), scalars.severity_colour().alias("colour")
    )


# --- forest ----------------------------------------------------------------------------------------------


@query
def iforest_fit(spark, sf):
    rows = features.ml_features(fx.auth_events(spark, sf))
    return forest.fit_nodes(forest.sample_per_tree(rows, features.ML_COLUMNS))


@query
def ml_detected(spark, sf):
    return forest.detect(fx.auth_events(spark, sf))


@query
def ml_detected_simple(spark, sf):
    return forest.detect_simple(fx.auth_events(spark, sf))


# --- graph -----------------------------------------------------------------------------------------------


def directed(spark, sf):
    return graph.links(graph.user_ip_edges(fx.auth_events(spark, sf)))


@query
def user_ip_edges(spark, sf):
    return graph.user_ip_edges(fx.auth_events(spark, sf))


@query
def node_degree(spark, sf):
    return graph.degree(directed(spark, sf))


@query
def closeness(spark, sf):
    return rounded(graph.closeness(directed(spark, sf)), "closeness")


@query
def betweenness(spark, sf):
    return rounded(graph.centrality(directed(spark, sf)).select("node", "betweenness"), "betweenness")


@query
def betweenness_estimate(spark, sf):
    """Whether the estimate from 100 pivots is within its bound of the exact value, per node."""
    links = directed(spark, sf)
    exact = graph.centrality(links).select("node", F.col("betweenness").alias("exact"))
    rows = graph.betweenness_estimate(links, 100, miss=1e-6).join(exact, "node")
    return whole(rows.select("node", (F.abs(F.col("betweenness") - F.col("exact")) <= F.col("bound") + 1e-9).alias("within")), "within")


@query
def clustering(spark, sf):
    return rounded(graph.clustering(graph.followers(fx.auth_events(spark, sf))), "clustering")


@query
def graph_anomalies(spark, sf):
    rows = graph.graph_anomalies(graph.centrality(directed(spark, sf)))
    return rounded(rows, "betweenness_z", "closeness_z")


@query
def advanced_anomalies(spark, sf):
    return graph.advanced_anomalies(fx.auth_events(spark, sf))


# --- federated -------------------------------------------------------------------------------------------

RATE, ROUNDS, PER_ROUND = 0.5, 5, 2


def client_rows(spark, sf):
    return features.client_features(fx.client_events(spark, sf), "client_id", "label")


def client_sizes(spark, sf):
    return fx.client_events(spark, sf).groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))


def first_step(spark, sf):
    """Client parameters after one gradient step from zero weights."""
    zero = [0.0] * (len(features.CLIENT_COLUMNS) + 1)
    rows = federated.scaled_by_client(client_rows(spark, sf))
    return federated.step(federated.gradient(rows, zero), RATE)


@query
def fed_weighted_mean(spark, sf):
    return rounded(federated.weighted_mean(fx.client_vectors(spark, sf), ["idx"], "grad", "weight"), "grad")


@query
def fed_gradient(spark, sf):
    weights = [0.1 * (i - 4) for i in range(len(features.CLIENT_COLUMNS) + 1)]
    grads = federated.gradient(federated.scaled_by_client(client_rows(spark, sf)), weights)
    return rounded(grads, "grad", places=4)


@query
def fed_average(spark, sf):
    return rounded(federated.average(first_step(spark, sf)), "value")


@query
def fed_local_fit(spark, sf):
    return federated.local_fit(client_rows(spark, sf))


@query
def fed_rounds(spark, sf):
    taking_part = federated.participants(client_sizes(spark, sf), ROUNDS, PER_ROUND)
    return federated.rounds(federated.local_fit(client_rows(spark, sf)), taking_part)


@query
def fed_status(spark, sf):
    sizes = client_sizes(spark, sf)
    return rounded(federated.status(sizes, federated.participants(sizes, ROUNDS, PER_ROUND)), "value")


@query
def fed_forest_params(spark, sf):
    """Client settings taken from each client's data: share of failed logins, and size-dependent counts."""
    configs = fx.client_events(spark, sf).groupBy("client_id").agg(
        F.avg((F.col("event_type") == "failed_login").cast("double")).alias("contamination"),
        (100 + F.count(F.lit(1)) % 7).alias("n_estimators"),
        F.least(F.lit(256), F.count(F.lit(1))).alias("max_samples"),
        (F.count("username") % 100).alias("random_state"),
    )
    return rounded(federated.forest_params(configs), "contamination")


@query
def fed_metrics(spark, sf):
    model = federated.average(first_step(spark, sf))
    return rounded(
        federated.evaluate(federated.predict(client_rows(spark, sf), model)), "accuracy", "precision", "recall"
    )


@query
def fed_detected(spark, sf):
    rows = features.client_features(fx.client_events(spark, sf), "client_id", *forest.BASE)
    return federated.detect(rows, federated.fit_forest(rows))


@query
def param_encryption(spark, sf):
    """Parameters after a round trip through encryption; the key is a demonstration value."""
    key = F.lit("0123456789abcdef").cast("binary")
    payloads = federated.encrypt_params(first_step(spark, sf), key)
    return rounded(federated.decrypt_params(payloads, key), "value")


# --- windows ---------------------------------------------------------------------------------------------

BASELINE_EVENTS = 1000


@query
def sliding_window_counts(spark, sf):
    return windows.window_counts(fx.auth_events(spark, sf))


@query
def window_metrics(spark, sf):
    return rounded(windows.window_metrics(fx.auth_events(spark, sf)), "login_rate_per_minute")


@query
def window_user_metrics(spark, sf):
    return rounded(windows.window_user_metrics(fx.auth_events(spark, sf)), "success_rate", "avg_hour")


@query
def stream_baseline(spark, sf):
    rows = windows.baseline(fx.auth_events(spark, sf), BASELINE_EVENTS)
    return joined_texts(rounded(rows, "avg_login_frequency"), "common_ips", "preferred_times")


@query
def volume_spike(spark, sf):
    events = fx.auth_events(spark, sf)
    rows = windows.volume_spikes(windows.window_metrics(events), windows.average_rate(events).scalar())
    return rounded(rows, "metric_value", "baseline_value")


@query
def stream_unusual_ip(spark, sf):
    events = fx.auth_events(spark, sf)
    users = windows.window_user_metrics(events, "3 days", "1 day")
    return whole(windows.unusual_ips(users, windows.baseline(events, BASELINE_EVENTS)), "is_unusual")


@query
def stream_behavior(spark, sf):
    users = windows.window_user_metrics(fx.auth_events(spark, sf), "3 days", "1 day")
    return windows.unusual_behaviour(users, windows.fit_behaviour(users))


@query
def streamed_windows(spark, sf):
    """Window totals and distinct counts from a real stream over the event files: the windows the watermark has closed."""
    out, state = scratch(spark, "windows"), scratch(spark, "windows-state")
    stream = windows.stream_metrics(fx.event_stream(spark, sf), "1 minute")
    windows.start(stream, out, state, available_now=True).awaitTermination()
    return rounded(spark.read.parquet(out), "login_rate_per_minute")


@query
def streamed_user_windows(spark, sf):
    """Windows per user of events that arrive up to two days late, in several micro-batches."""
    out, state = scratch(spark, "user-windows"), scratch(spark, "user-windows-state")
    stream = windows.stream_user_metrics(fx.shuffled_stream(spark, sf), fx.LATE_DELAY, "3 days", "1 day")
    windows.start(stream, out, state, available_now=True).awaitTermination()
    return rounded(spark.read.parquet(out), "success_rate", "avg_hour")


@query
def streamed_sessions(spark, sf):
    """Sessions of events that arrive up to two days late, in several micro-batches: those the watermark has closed."""
    out, state = scratch(spark, "sessions"), scratch(spark, "sessions-state")
    with stateful.state_store(spark):
        sessions = stateful.session_durations(fx.shuffled_stream(spark, sf), fx.LATE_DELAY, slot_minutes=1440)
        stateful.start_sessions(sessions, out, state, available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{out}/sessions").unionByName(spark.read.parquet(f"{out}/unpaired"))
    return rounded(rows.select("event_id", "username", "session_hours"), "session_hours")


# --- whole runs ------------------------------------------------------------------------------------------


@query
def end_to_end(spark, sf):
    """All detectors with explanations, as one table of explained anomalies."""
    return joined_texts(runs.explained_run(fx.auth_events(spark, sf)), "rule_based", "rarity")
