"""Spark-native analytics over timestamped wearable and phone sensor tables."""

__version__ = "0.1.0"
