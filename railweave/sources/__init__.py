"""Catalogs, feeds and station references."""
