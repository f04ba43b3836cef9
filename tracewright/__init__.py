"""Spark-native analytics for record sets, event logs, tool graphs and training releases."""
