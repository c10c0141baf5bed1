"""Spark-native analytics over captured HTTP traffic and business-registry records."""

__version__ = "0.1.0"
