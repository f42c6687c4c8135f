"""Spark-native analytics for security advisories (DataFrame in, DataFrame out)."""
