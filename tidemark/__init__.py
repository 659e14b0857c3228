"""Spark-first engine for building, checking and measuring document catalogues."""

__version__ = "0.1.0"
