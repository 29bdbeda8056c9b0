"""Estimators: Spark ML where it has them, otherwise aggregates over the cluster."""
