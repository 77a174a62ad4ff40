"""Structured Streaming jobs built from the same expressions as the batch plans."""
