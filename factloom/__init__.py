"""Spark-native analytics for checking summaries against their sources."""

__version__ = "0.1.0"
