"""Shredding, repair, enrichment, pivots and merge."""
