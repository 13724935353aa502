"""Scans, sinks and table schemas."""
