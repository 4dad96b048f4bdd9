"""Spark-native supplier and merchant analytics."""
