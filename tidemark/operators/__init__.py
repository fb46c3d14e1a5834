"""Relational operators: enrichment join, rollups, current view, checks."""
