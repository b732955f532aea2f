"""Tidemark: detection time-series analytics on Spark."""
