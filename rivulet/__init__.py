"""Spark-native datasets of timestamped customer events, and the operators that build them."""

__version__ = "0.1.0"
