"""Joins, aggregations and entity resolution over feed tables."""
