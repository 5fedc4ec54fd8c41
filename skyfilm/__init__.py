"""Spark-native analytics for digitised scientific film archives."""

__version__ = "0.1.0"
