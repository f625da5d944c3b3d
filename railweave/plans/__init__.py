"""Whole jobs: the three ingestion plans, their sinks, and the queries over their tables."""
