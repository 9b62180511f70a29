"""Spark-native spatial read counting."""
