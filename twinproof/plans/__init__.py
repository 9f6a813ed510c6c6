"""Whole runs: copy, verify, copy with change apply."""
