"""Operators of a training-data pipeline: packing, filters, scoring, formatting, near and exact duplicates, tokens."""
