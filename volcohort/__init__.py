"""Spark-native cohort analytics."""
