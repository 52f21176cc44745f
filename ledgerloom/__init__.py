"""Spark-native engine for entity registries."""
