"""Spark-first analytics library: panel features, point-in-time joins, a snapshot store and data checks."""

__version__ = "0.1.0"
