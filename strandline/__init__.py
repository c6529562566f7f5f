"""Spark-native column lineage engine and training-data operators."""

__version__ = "0.1.0"
