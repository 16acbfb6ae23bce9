"""Spark-native analytics for structured text corpora."""

__version__ = "0.1.0"
