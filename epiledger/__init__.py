"""Spark-native analytics over daily reports from a geographic hierarchy."""
