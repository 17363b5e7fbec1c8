"""Spark-native trip analytics: quality flags, marts, gates, reports, periods."""
