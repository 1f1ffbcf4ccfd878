"""Structured Streaming versions of the scoring and counting operators."""
