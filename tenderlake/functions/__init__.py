"""Spark-first analytics over public-procurement style tables."""
