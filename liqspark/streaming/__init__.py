"""Structured Streaming: quote topic -> windows -> enrichment -> sinks."""
