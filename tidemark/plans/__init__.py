"""Batch plans: backfill and the read-side report library."""
