"""Spark-native analytics engine for real-estate listing data."""

__version__ = "0.1.0"
