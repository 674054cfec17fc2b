"""Batch marts, spatial joins and data-quality checks as ordinary Spark jobs."""
