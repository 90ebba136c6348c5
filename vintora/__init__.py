"""Vintora: point-in-time release analytics, and training-data jobs, as Spark DataFrame operators."""
