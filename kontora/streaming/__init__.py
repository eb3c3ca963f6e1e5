"""Structured Streaming jobs over the transaction feed."""
