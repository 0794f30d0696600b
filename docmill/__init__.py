"""Spark-native document pipeline: ingest, normalise, check, search, evaluate, report."""
