"""Loads, reports and the query catalogue."""
