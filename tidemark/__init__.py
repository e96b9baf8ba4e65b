"""Spark-first analytics over company statements, market prices and news."""

__version__ = "0.1.0"
