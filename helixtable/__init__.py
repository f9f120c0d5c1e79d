"""Spark-native analytics over protein-domain hits and annotation reports."""
