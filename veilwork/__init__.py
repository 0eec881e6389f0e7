"""Spark-native redaction engine: typed span detection, merging and masking over text columns."""

__version__ = "0.1.0"
