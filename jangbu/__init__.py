"""Retail price survey analytics as Spark DataFrame transforms."""

__version__ = "0.1.0"
