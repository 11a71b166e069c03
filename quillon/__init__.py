"""Spark-native analytics over encyclopedia page dumps and knowledge-base entity dumps."""

__version__ = "0.1.0"
