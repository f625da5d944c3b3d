"""Incremental landing of feeds."""
