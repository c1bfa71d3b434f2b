"""Spark-native volatility features, scoring, drift and alert analytics."""
