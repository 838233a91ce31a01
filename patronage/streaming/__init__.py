"""Structured Streaming variants of the core aggregates."""
