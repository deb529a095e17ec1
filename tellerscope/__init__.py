"""Retail-bank fraud analytics as plain Spark DataFrame jobs."""
