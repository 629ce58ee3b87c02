"""Structured Streaming: landing, deduplication, order loading, query control."""
