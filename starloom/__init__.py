"""Spark-native layered warehouse: ingest, data quality, history, facts, marts."""

__version__ = "0.1.0"
