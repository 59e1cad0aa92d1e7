"""Spark-native preparation of labelled audio corpora and their embedding tables."""

__version__ = "0.1.0"
