"""Structured Streaming jobs: landing and flush batches."""
