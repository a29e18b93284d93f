"""Spark-native telemetry lakehouse: Bronze -> Silver -> marts -> serving."""
