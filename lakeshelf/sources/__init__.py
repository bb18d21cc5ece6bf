"""Scans, sinks, versioned tables and state marks."""
