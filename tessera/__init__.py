"""Tessera: a Spark-native analytics engine over named Parquet and CSV tables."""

__version__ = "0.1.0"
