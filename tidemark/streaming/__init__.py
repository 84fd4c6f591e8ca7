"""Incremental (day-at-a-time) drivers built on Structured Streaming."""
