"""Suspicious-listing analytics as Spark DataFrame and Spark ML jobs."""
