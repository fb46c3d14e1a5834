"""Structured Streaming pipeline and its monitoring."""
