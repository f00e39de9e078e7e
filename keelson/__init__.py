"""Spark-native data work behind a feature store and its training loop."""
