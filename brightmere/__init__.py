"""Brightmere: lakehouse loads, quality checks, increments, streams and features on Spark."""

__version__ = "0.1.0"
