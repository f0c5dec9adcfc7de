"""Spark-native analytics for event-level sports data and training corpora."""
