"""Structured Streaming: message projection, classification, stream-static
enrichment and alert routing."""
