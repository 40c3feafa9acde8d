"""Structured Streaming form of the incremental Bronze -> Silver step."""
