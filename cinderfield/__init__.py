"""Geo-temporal fire-risk tables on Spark: features, labels, splits and evaluation."""

__version__ = "0.1.0"
