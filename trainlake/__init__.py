"""Spark-native tabular machine learning and text-trend jobs."""
