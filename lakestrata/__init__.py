"""Layered (raw -> cleaned -> curated) table analytics as plain Spark jobs."""
