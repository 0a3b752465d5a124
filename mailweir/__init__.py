"""Spark-native mail ingest and quality analytics."""
