"""Soil-test analytics on Apache Spark: ingest, clean, explore, train, predict."""

__version__ = "0.1.0"
