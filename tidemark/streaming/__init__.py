"""Structured Streaming forms of landing, cleaning and upsert."""
