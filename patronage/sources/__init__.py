"""Scans, fixtures and sinks."""
