"""Retail and call-sentiment analytics as Spark DataFrame jobs."""
