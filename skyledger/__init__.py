"""Spark-native processing of airline on-time-performance records."""

__version__ = "0.1.0"
