"""Blockchain payloads to analytics tables, as plain Spark DataFrame jobs."""
