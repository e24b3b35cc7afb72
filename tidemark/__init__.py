"""Streaming-learning and drift analytics as Spark jobs."""
