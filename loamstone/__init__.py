"""Spark-native analytics over curated research documents and numeric series."""

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
__version__ = "0.1.0"
