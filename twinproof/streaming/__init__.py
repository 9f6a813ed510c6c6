"""Structured Streaming jobs: change apply, lag monitor, cutover."""
