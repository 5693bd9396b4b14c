"""Spark-native transit analytics: parsers, silver/gold models, dashboards, checks."""
