"""Spark-first engine for turning text archives into clean corpora."""
