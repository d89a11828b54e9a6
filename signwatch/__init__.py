"""Spark-native analytics for login and access events."""
