"""Spark-native retail analytics: every public function maps DataFrames to a DataFrame."""
